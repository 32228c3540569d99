"""The trie of conversations against one built turn by turn."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from genoweave.llm import prefix_trie

SCHEMA = "turn long, conv_id long, text string, role string, depth string, block string, n string"


def brute(rows):
    own = defaultdict(list)
    for turn, conv, text, role, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    path = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        path[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c in sorted(path):
        for d in range(len(path[c]) + 1):
            members[tuple(path[c][:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, who in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(who) - 1) * words
    out = Counter()
    for p, who in members.items():
        ends = hashlib.sha256(",".join(str(c) for c in who if len(path[c]) == len(p)).encode()).hexdigest()
        out[who[0], len(p), members[p[:-1]][0] if p else None, len(who), children[p], leaves[p], saved[p], ends] += 1
    return out


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(spark, rows):
    df = prefix_trie.prefix_trie(spark.createDataFrame([(*r, *["x"] * (7 - len(r))) for r in rows], SCHEMA).repartition(5))
    return Counter(map(tuple, df.select(*COLUMNS).collect()))


def conversations(seed, convs, most, choices):
    """Turns from few texts, so that prefixes are shared and part at all places."""
    rng = random.Random(seed)
    rows = []
    for c in convs:
        for t in range(rng.randrange(1, most)):
            rows.append((t, c, "say " * rng.randrange(choices), "user" if t % 2 == 0 else "assistant"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, most, choices", [(0, 6, 2), (1, 12, 2), (2, 14, 1), (3, 4, 5)])
def test_trie(spark, seed, most, choices):
    rows = conversations(seed, range(90), most, choices)
    assert found(spark, rows) == brute(rows)


def test_cases(spark):
    rng = random.Random(5)
    copies = [(t, c, f"turn {t} of many", "user") for c in range(500, 760) for t in range(6)]  # a third and more of all
    long = [(t, 41, f"long {t % 7}", "user") for t in range(900)] + [(t, 43, f"long {t % 7}", "user") for t in range(880)]
    odd = [(None, 7, None, None), (None, 7, "b", None), (1, 7, "", ""), (1, 7, "", ""), (2, None, "none", "user"), (0, -3, "minus", "user"), (1, -3, "two", None),
           (0, 8, "x" * 200_000 + " y", "user"), (3, 8, "a\x0bb\x1cc d", "user"), (0, 10_000_019, "far", "user"), (0, 9, "bc", "a"), (0, 11, "c", "ab")]
    rows = copies + long + odd
    rng.shuffle(rows)
    assert found(spark, rows) == brute(rows)


def test_small_tables(spark):
    assert found(spark, []) == brute([]) == Counter()
    for rows in ([(0, 3, "only", "user")], [(0, None, "no", "user")], [(0, 2, "a", "u"), (0, 4, "a", "u")]):
        assert found(spark, rows) == brute(rows)


def test_pieces_of_ending_members(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 40)
    ends = [(0, 1, 2, 3, 4, c) for c in range(0, 900, 7)] + [(2, 1, 1, 1, 1, 5), (3, 1, 1, 1, 1, 12), (3, 1, 1, 1, 1, 9)]
    df = spark.createDataFrame(ends, "depth long, s1 long, s2 long, s3 long, s4 long, conv_id long").repartition(4)
    got = {r["depth"]: r["ends_sha256"] for r in prefix_trie.ends_digests(df).collect()}
    join = {0: ",".join(map(str, range(0, 900, 7))), 2: "5", 3: "9,12"}
    assert got == {d: hashlib.sha256(x.encode()).hexdigest() for d, x in join.items()}


def test_only_diverging_blocks_are_refined(spark):
    """Two families of copies: no siblings but at the root, and only one member's turns are looked at."""
    rows = [(t, c, f"t{t}", "user") for c in range(0, 2000, 20) for t in range(12)]
    convs, path = prefix_trie.rebuilt(spark.createDataFrame([(*r, *["x"] * 3) for r in rows], SCHEMA))
    trie = prefix_trie.Trie(path)
    assert trie.groups.filter("not alone").count() == 0
    assert trie.members.count() == 12 and trie.blocks.count() == 300
