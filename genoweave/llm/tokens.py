"""Token ids of whole texts, with a bounded memo of pieces that recur.

A byte-level tokenizer whose pre-tokens take at most one leading space always begins a new
pre-token at a space that a character other than white space follows, and a line feed that such a
character follows is a pre-token of its own. Texts are cut there, and each cut is encoded once as long
as the memo holds it. A cut is encoded by the library itself, so the ids are those of the whole text.
"""

from __future__ import annotations

import base64
import json
import os
import re
import sys
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np

#: Cuts in a generation of a Python worker's memo.
MEMO = 600_000
#: Longer cuts are not remembered.
MEMO_CHARS = 64

_HARD = re.compile(r" (?:\s|\Z)")
_CUT = re.compile(r" (?=\S)")
_HARD_LINE = re.compile(r"\n(?:\s|\Z)")
_LINE = re.compile(r"\n(?=\S)")


def cuts(text: str) -> list[str]:
    """The pieces of `text` by the keys of the memo: a line feed stands in front of those that begin
    the text or a line, and as a piece of its own between lines; the others had a space in front."""
    out = []
    for k, line in enumerate(_LINE.split(text) if _HARD_LINE.search(text) else text.split("\n")):
        if k:
            out.append("\n")
        parts = _CUT.split(line) if _HARD.search(line) else line.split(" ")
        if parts[0]:
            parts[0] = "\n" + parts[0]
            out += parts
        else:
            out += parts[1:]
    return out


def as_text(key: str) -> str:
    return key[1:] or key if key[0] == "\n" else " " + key


class Encoder:
    """Ids of whole texts. `encode_many` gives the ids of strings that are cuts.

    The memo has two generations: what the present one lacks is taken over from the one before, so
    frequent cuts stay. A letter and a full stop or comma after it are always separate pre-tokens,
    so an unknown cut that ends so is put together from its parts.
    """

    def __init__(self, encode_many: Callable[[list[str]], list[bytes]], most: int = 2 * MEMO):
        self.encode_many, self.most = encode_many, most // 2
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.tails = dict(zip(".,", encode_many([".", ","])))
        self.feed = encode_many(["\n"])[0]

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        memo, older, tails = self.memo, self.older, self.tails
        found = {x: older[x] for x in new if x in older}
        cores, tailed = {}, []
        for x in new if not found else [x for x in new if x not in found]:
            if x[-1] in tails and x[-2:-1].isalpha():
                core = x[:-1]
                tailed.append((x, core))
                if core in memo or core in older:
                    continue
                cores[core] = None
            else:
                cores[x] = None
        ids = dict(zip(cores, self.encode_many([as_text(x) for x in cores])))
        for x, core in tailed:
            found[x] = (ids.get(core) or memo.get(core) or older[core]) + tails[x[-1]]
        found.update(ids)
        return found

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.memo) > self.most:
            self.memo, self.older = {}, self.memo
        memo = self.memo
        memo["\n"] = self.feed
        split = [cuts(text) for text in texts]
        found = self._learn(list(set().union(*split).difference(memo)))
        memo.update(found)
        out = [b"".join(map(memo.__getitem__, x)) for x in split]
        for x in found:
            if len(x) > MEMO_CHARS:
                del memo[x]
        return out


class WholeEncoder:
    """Ids of whole texts by the library alone, for files whose pre-tokens are other ones."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer

    def __call__(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]


def byte_characters() -> list[str]:
    """The character that byte-level files write for each byte: printable ones stand for themselves, the
    others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = {b: 0x100 + k for k, b in enumerate(sorted(set(range(256)).difference(plain)))}
    return [chr(rest.get(b, b)) for b in range(256)]


def cuts_hold(tokenizer) -> bool:
    """True if the file's pre-tokens begin where `cuts` cuts: plain byte-level ones, no normalisation."""
    part = tokenizer.pre_tokenizer
    state = json.loads(part.__getstate__()) if part is not None else {}
    return state.get("type") == "ByteLevel" and state.get("use_regex", True) and not state.get("add_prefix_space") and tokenizer.normalizer is None


@lru_cache(maxsize=4)
def library_encoder(path: str, memo: int = MEMO) -> Encoder | WholeEncoder:
    """Ids by a tokenizers file, without special tokens; their strings in a text are plain text. `memo`: cuts in a generation of the memo."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    if not cuts_hold(tokenizer):
        return WholeEncoder(tokenizer)
    tokenize, chars = tokenizer.model.tokenize, dict(enumerate(byte_characters()))
    special = [x.content.strip() for x in tokenizer.get_added_tokens_decoder().values()]
    simple = not any(x.isalpha() for x in special) and sys.byteorder == "little" and array("I").itemsize == 4
    space = chars[0x20]

    def many(pieces: list[str]) -> list[bytes]:
        """Letters with at most a space in front are one pre-token, which the library's model takes as it is;
        letters are those up to U+052F, which every version of Unicode in use agrees on."""
        out: list[bytes] = [b""] * len(pieces)
        left = []
        for k, x in enumerate(pieces):
            core = x[1:] if x[:1] == " " else x
            if not (simple and core.isalpha()):
                left.append(k)
            elif x.isascii():
                out[k] = array("I", [t.id for t in tokenize(x.replace(" ", space))]).tobytes()
            elif max(core) < "\u0530":
                out[k] = array("I", [t.id for t in tokenize(x.encode().decode("latin-1").translate(chars))]).tobytes()
            else:
                left.append(k)
        left = [k for k in left if pieces[k]]
        for a in range(0, len(left), 2000):
            found = tokenizer.encode_batch_fast([pieces[k] for k in left[a : a + 2000]], add_special_tokens=False)
            for k, x in zip(left[a : a + 2000], found):
                out[k] = np.array(x.ids, dtype="<u4").tobytes()
        return out

    return Encoder(many, 2 * memo)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
