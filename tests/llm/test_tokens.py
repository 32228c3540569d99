"""Token ids, their ORC files, byte-level pieces and packing against the libraries themselves."""

import base64
import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from genoweave.llm import bpe_pieces, packing, token_orc, tokens

LIBRARY, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def direct():
    tokenizer = Tokenizer.from_file(LIBRARY)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def order(row):
    return (row[0] is not None, row[0] or 0, row[1] or "")


def test_encoder_is_the_library(rows, direct):
    encoder = tokens.library_encoder(LIBRARY)
    texts = [r[1] or "" for r in rows] + ["a  b", " lead", "tail ", "\n x", "x \n y", "  z", ". . ,", "a, b.", "é. ü,"]
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder(texts)] == [direct(x) for x in texts]


def test_encoders_on_random_texts(direct):
    import random

    rng = random.Random(6)
    parts = ["a", "b", "Ω", "ж", "ʰ", "\u0530", "ª", "ǅ", "é", " ", "  ", "\n", "\n\n", "\r", "\t", ".", ",", "'s", "1", "\x0b", "\x1c", "\x85", "\u3000", "日", "🙂", "<|endoftext|>", "\0", "e\u0301"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(3000)]
    assert [np.frombuffer(x, "<u4").tolist() for x in tokens.library_encoder(LIBRARY)(texts)] == [direct(x) for x in texts]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encode = bpe_pieces.encoder_of(RANKS, P.PATTERN).encode
    assert [np.frombuffer(x, "<u4").tolist() for x in encode(texts)] == [plain.encode_ordinary(x) for x in texts]


def test_orc_files(spark, docs, rows, direct, tmp_path):
    path = str(tmp_path / "orc")
    token_orc.write_token_orc(docs, path, LIBRARY)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in token_orc.token_spans(spark, path).collect())
    start, expected = 0, []
    for row in sorted(rows, key=order):
        ids = direct(row[1]) + [0]
        expected.append((start, row[0], len(ids), crc(ids)))
        start += len(ids)
    assert got == expected


def test_orc_files_are_pruned(spark, docs, tmp_path):
    import pyarrow.orc as orc

    path = tmp_path / "orc"
    token_orc.write_token_orc(docs, str(path), LIBRARY)
    found = token_orc.read_token_orc(spark, str(path)).filter("doc_id = 7")
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,7)]" in found._jdf.queryExecution().toString()
    assert found.count() == 2
    assert orc.ORCFile(next(path.glob("*.orc"))).schema.field("ids").type.value_type == "int32"


def test_empty_orc(spark, no_docs, tmp_path):
    token_orc.write_token_orc(no_docs, str(tmp_path / "orc"), LIBRARY)
    assert token_orc.token_spans(spark, str(tmp_path / "orc")).count() == 0


def test_pieces_are_the_ranks_library(docs, rows):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoded = bpe_pieces.encode_documents(docs, RANKS, P.PATTERN)
    decoded = bpe_pieces.decode_documents(encoded, RANKS).collect()
    expected = Counter((r[0], tuple(plain.encode_ordinary(r[1] or "")), (r[1] or "").encode()) for r in rows)
    assert Counter((r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in decoded) == expected
    digests = bpe_pieces.round_trip(docs, RANKS, P.PATTERN).collect()
    sha = lambda x: hashlib.sha256(x).hexdigest()
    of_rows = Counter((i, len(ids), sha(",".join(map(str, ids)).encode()), sha(text)) for i, ids, text in expected.elements())
    assert Counter(map(tuple, digests)) == of_rows


def test_decoding_takes_the_pieces_of_the_model():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"\xff\x00": 257, "é".encode(): 258}
    decoder = bpe_pieces.PieceDecoder(bpe_pieces._processor(ranks))
    assert [decoder.decode([k]) for k in ranks.values()] == list(ranks)


def test_files_with_other_pre_tokens_are_encoded_whole(rows):
    path = P.path("word_bpe_49k.json")
    encoder = tokens.library_encoder(path)
    assert isinstance(encoder, tokens.WholeEncoder)
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    texts = [r[1] or "" for r in rows]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder(texts)] == [tokenizer.encode(x, add_special_tokens=False).ids for x in texts]


def test_no_pieces(no_docs):
    encoded = bpe_pieces.encode_documents(no_docs, RANKS, P.PATTERN)
    assert bpe_pieces.decode_documents(encoded, RANKS).count() == 0


@pytest.mark.parametrize("size", [16, 1024])
def test_packing(docs, rows, direct, size):
    got = packing.pack_documents(docs, LIBRARY, size).collect()
    expected = Counter()
    for row in rows:
        ids, start, number = direct(row[1]) + [2], 0, 0
        while start < len(ids):
            length = (len(ids) - start) % size or size if start == 0 else size
            expected[row[0], number, start, length, crc(ids[start : start + length])] += 1
            start, number = start + length, number + 1
    assert Counter(tuple(r)[:5] for r in got) == expected
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    lengths = np.array([r["length"] for r in got])
    assert len(bins) <= packing.lower_bound(lengths, size) + 1


def test_packing_in_rounds(docs, monkeypatch):
    monkeypatch.setattr(packing, "PART_ROWS", 40)
    pieces = packing.cut_pieces(docs, LIBRARY, 32, 2).cache()
    got = packing.pack_pieces(pieces, 32).collect()
    assert len(got) == pieces.count()
    fill = Counter()
    for r in got:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 32
    assert len(fill) <= packing.lower_bound(np.array([r["length"] for r in got]), 32) + 2


def test_bound_and_best_fit():
    assert packing.lower_bound(np.array([6, 6, 6]), 10) == 3  # the sum alone gives two
    rng = np.random.default_rng(1)
    for _ in range(50):
        lengths = rng.integers(1, 101, rng.integers(1, 60))
        bins, offsets, fill = packing.best_fit(lengths, 100)
        assert fill.max() <= 100 and fill.sum() == lengths.sum()
        assert math.ceil(lengths.sum() / 100) <= packing.lower_bound(lengths, 100) <= len(fill)


def test_sequences(spark, direct):
    docs = spark.createDataFrame([(1, "a b c"), (2, "d e f g"), (3, "")], "doc_id long, text string")
    places = packing.pack_documents(docs, LIBRARY, 6).cache()
    ids = [x for r in packing.sequences(docs, places, LIBRARY).collect() for x in r["ids"]]
    assert Counter(ids) == Counter(x for t in ("a b c", "d e f g", "") for x in direct(t) + [2])


def test_nothing_to_pack(no_docs):
    assert packing.pack_documents(no_docs, LIBRARY).count() == 0


def test_memo_bound(direct):
    """A small memo forgets cuts, and the ids stay those of the library."""
    encoder = tokens.library_encoder(LIBRARY, 50)
    for k in range(20):
        texts = [" ".join(f"word{k}x{i}" for i in range(40))]
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder(texts)] == [direct(x) for x in texts]
    assert len(encoder.memo) + len(encoder.older) < 250
