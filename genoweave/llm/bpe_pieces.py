"""Byte-level BPE through a sentencepiece model made from the ranks alone.

The model is serialised here: each token's bytes are mapped to characters, one per byte, and the
piece is scored by its negative rank, so that the library's merges (highest score first, leftmost
first) are those of the ranks. Normalisation is the identity: no dummy prefix, no escaped or removed
white space. Pre-tokens are encoded one by one; one that is a token itself takes its rank at once, as
the ranks' own library does. Decoding takes the model's pieces and maps their characters back to bytes. The
registered query encodes, decodes and digests a slice of texts in one pass of one Python worker.

Null texts count as empty. An empty text has no ids. Repeated rows are kept; an empty table gives no
rows. Columns other than `doc_id` and `text` are not read.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from genoweave.llm.common import documents, slices
from genoweave.llm.tokens import Encoder, read_ranks

#: Bytes of an encoder's memo, and what a cut takes there with its ids, about.
MEMO_BYTES, CUT_BYTES = 160 << 20, 240
#: Byte b is written as this character; all of them are letters without a special meaning.
BYTE_CHARS = [chr(0x4E00 + b) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while True:
        n, low = n >> 7, n & 127
        out.append(low | (128 if n else 0))
        if not n:
            return bytes(out)


def _field(number: int, value: int | float | bytes) -> bytes:
    """One field of a protocol buffer: varint, 32-bit float or bytes."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def serialise_model(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece model whose piece ids are the ranks; the unknown piece comes last.

    Fixed numbers of the format: ModelProto pieces 1, trainer 2, normalizer 3; a piece has piece 1,
    score 2, type 3 (1 normal, 2 unknown); trainer model_type 3 (2: BPE), vocab_size 4, unk_id 40,
    bos_id 41, eos_id 42, pad_id 43; normalizer name 1, add_dummy_prefix 3,
    remove_extra_whitespaces 4, escape_whitespaces 5.
    """
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[x] for x in tokens] != list(range(len(tokens))):
        raise ValueError("ranks are not 0, 1, 2, ...")
    out = []
    for rank, token in enumerate(tokens):
        piece = "".join(BYTE_CHARS[b] for b in token).encode()
        out.append(_field(1, _field(1, piece) + _field(2, float(-rank)) + _field(3, 1)))
    unknown = _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2)
    none = (1 << 64) - 1  # -1
    trainer = _field(3, 2) + _field(4, len(tokens) + 1) + _field(40, len(tokens))
    trainer += _field(41, none) + _field(42, none) + _field(43, none)
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(out) + _field(1, unknown) + _field(2, trainer) + _field(3, normalizer)


def _processor(ranks: dict[bytes, int]):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=serialise_model(ranks))


class PieceEncoder:
    """Encodes whole texts by a file of ranks."""

    def __init__(self, path: str, pattern: str, memo: int = MEMO_BYTES):
        import regex

        self.ranks = read_ranks(path)
        self.model = _processor(self.ranks)
        self.pieces = regex.compile(pattern).findall
        self.encode = Encoder(self._many, memo // CUT_BYTES)

    def _many(self, cuts: list[str]) -> list[bytes]:
        split = [[x.encode() for x in self.pieces(cut)] for cut in cuts]
        rare = list({x for pieces in split for x in pieces if x not in self.ranks})
        mapped = [x.decode("latin-1").translate(_TO_CHARS) for x in rare]
        found = dict(zip(rare, self.model.encode(mapped, num_threads=1))) if rare else {}
        ids = [[y for x in p for y in ((self.ranks[x],) if x in self.ranks else found[x])] for p in split]
        return [np.array(x, dtype="<u4").tobytes() for x in ids]


class PieceDecoder:
    """The bytes of each piece of a model, by the inverse of the byte characters."""

    def __init__(self, model):
        pieces = model.id_to_piece(list(range(model.get_piece_size() - 1)))
        self.bytes = [piece.translate(_TO_LATIN).encode("latin-1") for piece in pieces]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


_TO_CHARS = {b: BYTE_CHARS[b] for b in range(256)}
_TO_LATIN = {ord(c): chr(b) for b, c in enumerate(BYTE_CHARS)}


@lru_cache(maxsize=2)
def encoder_of(path: str, pattern: str) -> PieceEncoder:
    return PieceEncoder(path, pattern)


@lru_cache(maxsize=2)
def decoder_of(path: str) -> PieceDecoder:
    return PieceDecoder(_processor(read_ranks(path)))


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """`doc_id` and `ids`, an array of the ranks of its tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder_of(path, pattern).encode
        for batch in batches:
            for part in slices(batch, "text"):
                ids = encode(part.column("text").to_pylist())
                offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])])
                values = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], ["doc_id", "ids"])

    return documents(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """`doc_id`, `ids` and `decoded`, the bytes that the ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = decoder_of(path).decode
        for batch in batches:
            ids = batch.column("ids")
            values, offsets = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
            decoded = [decode(values[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), ids, pa.array(decoded, pa.binary())], ["doc_id", "ids", "decoded"]
            )

    return encoded.mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """`doc_id`, `n_tokens`, and the digests of its ids and of the bytes they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path, pattern)
        decode = PieceDecoder(encoder.model).decode
        sha = hashlib.sha256
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                counts, of_ids, of_bytes = [], [], []
                for packed in encoder.encode(part.column("text").to_pylist()):
                    ids = np.frombuffer(packed, "<u4").tolist()
                    counts.append(len(ids))
                    of_ids.append(sha(",".join(map(str, ids)).encode()).hexdigest())
                    of_bytes.append(sha(decode(ids)).hexdigest())
                arrays = [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return documents(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
