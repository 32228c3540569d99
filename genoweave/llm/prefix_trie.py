"""The trie of conversation prefixes, by fixed-length block hashing.

A turn's digest covers its place, role and text; the digests of a stretch of turns add up, lane by
lane, so a prefix of any length has a digest that Spark sums. Turns are first added up to blocks of
`BLOCK` turns and blocks to prefixes; conversations are grouped by their successive block prefixes, and a
group keeps its size and its smallest member. Only that member's turns are looked at again: where a
group is its parent's only continuation, no two conversations part inside the block, so its turns
are nodes as they stand; where siblings diverge, the turn prefixes of the siblings' members are merged, with the
groups' sizes as weights. A conversation that thousands repeat is thus one member's turns.

Sums over subtrees need no walk. A node belongs to its smallest member, and a member owns the lower end
of its own path; what a subtree holds is what its members own, less what the owner owns above the
node. So every such sum is again a sum of weights over members, block by block.

Places and running sums are numbered over range partitions (`running_sums`), so neither a conversation of
very many turns nor a prefix of very many conversations is one task's work. The one thing that stays
in order is the SHA-256 of a node's ending members: they are range-partitioned and sorted, joined to
pieces of at most `PIECE` characters where they lie, and the pieces of a node are hashed as a stream.

Turns are in the order of `turn`, nulls first; turns of one number are in the order of their digest (MD5
of the role's length, role and text). Null roles and texts are empty. Rows with a null `conv_id` are of no conversation. Repeated rows
are turns of their own. Very long texts are only digested. An empty table gives no rows. Other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoweave.llm.common import keep_in

#: Turns of a block.
BLOCK = 4
#: Characters of joined ids that one row carries.
PIECE = 1 << 20
LANES = ["s1", "s2", "s3", "s4"]
PREFIX = ["depth", *LANES]


def running_sums(df: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column]) -> DataFrame:
    """Adds, per name, the sum of its column over the rows of the group before each row, itself included.

    Rows are range-partitioned, written and summed up inside each partition; a partition starts from
    the sums of the earlier ones. `order` has to be total but for rows that are alike.
    """
    inputs = {f"_in_{n}": c for n, c in sums.items()}
    ranged = keep_in(df.withColumns(inputs).repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id()), "running")
    inside = Window.partitionBy("_part", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each group and partition that meet; a group of very many rows has few of these.
    parts = ranged.groupBy(*keys, "_part").agg(*[F.sum(f"_in_{n}").alias(f"_all_{n}") for n in sums])
    starts = parts.select(*keys, "_part", *[F.coalesce(F.sum(f"_all_{n}").over(before), F.lit(0)).alias(f"_start_{n}") for n in sums])
    summed = ranged.withColumns({f"_here_{n}": F.sum(f"_in_{n}").over(inside) for n in sums})
    done = summed.join(starts, [*keys, "_part"])
    return done.select(*df.columns, *[(F.col(f"_here_{n}") + F.col(f"_start_{n}")).alias(n) for n in sums])


def _lanes(digest: Column) -> list[Column]:
    """Four 32-bit parts of a hexadecimal digest, whose sums never leave 63 bits."""
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def turns(conversations: DataFrame) -> DataFrame:
    """`conv_id`, `pos` (from 0), `digest`, `words` per row."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    placed = running_sums(rows, ["conv_id"], ["turn", "digest"], {"pos": F.lit(1).cast("long")})
    return placed.select("conv_id", (F.col("pos") - 1).alias("pos"), "digest", "words")


def rebuilt(conversations: DataFrame, family: int = 20, most_heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """(`conv_id`, `n_turns`) of all conversations, and (`conv_id`, `depth`, `digest`, `words`) of their
    rebuilt turns: the first h of the family's first conversation, then their own after the first h, with
    h = crc32(conv_id) % `most_heads`."""
    own = keep_in(turns(conversations), "turns")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most_heads).cast("long")
    convs = own.groupBy("conv_id").agg(F.count("*").alias("n"))
    convs = keep_in(convs.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.pmod("conv_id", F.lit(family))).alias("base")), "convs")
    sizes = convs.filter("conv_id = base").select("base", F.col("n").alias("n_base"))
    convs = convs.join(sizes, "base", "left").withColumn("heads", F.least("h", F.coalesce("n_base", F.lit(0))))
    total = convs.select("conv_id", (F.col("heads") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns"))
    # At most most_heads - 1 turns of a conversation, for at most `family` others.
    first = own.filter(F.col("pos") < most_heads - 1).select(F.col("conv_id").alias("base"), "pos", "digest", "words")
    heads = convs.filter("heads > 0").select("conv_id", "base", "heads").join(first, "base").filter("pos < heads")
    heads = heads.select("conv_id", (F.col("pos") + 1).alias("depth"), "digest", "words")
    rest = own.join(convs.select("conv_id", "h", "heads"), "conv_id").filter("pos >= h")
    rest = rest.select("conv_id", (F.col("pos") - F.col("h") + F.col("heads") + 1).alias("depth"), "digest", "words")
    return total, heads.unionByName(rest)


def _as_parent(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).alias(f"up_{c}") if c in PREFIX else F.col(c) for c in df.columns])


class Trie:
    """Blocks, groups and nodes of rebuilt conversations; every part is written once."""

    def __init__(self, path: DataFrame):
        """`path`: (`conv_id`, `depth`, `digest`, `words`) of all turns."""
        placed = F.md5(F.concat_ws(":", F.col("depth").cast("string"), "digest"))
        block = F.expr(f"(depth - 1) div {BLOCK}")
        steps = path.select("conv_id", block.alias("block"), "depth", "words", placed.alias("mark"))
        self.steps = keep_in(steps.select("conv_id", "block", "depth", "words", *[c.alias(n) for n, c in zip(LANES, _lanes(F.col("mark")))]), "steps")
        added = self.steps.groupBy("conv_id", "block").agg(F.max("depth").alias("depth"), *[F.sum(n).alias(f"d_{n}") for n in LANES])
        prefixes = running_sums(added, ["conv_id"], ["block"], {n: F.col(f"d_{n}") for n in LANES})
        before = {f"up_{n}": F.col(n) - F.col(f"d_{n}") for n in LANES}
        #: A row per conversation and block: the prefix at its end, and the one before it.
        self.blocks = keep_in(prefixes.withColumns(before).select("conv_id", "block", *PREFIX, *before), "blocks")
        groups = self.blocks.groupBy("block", *PREFIX).agg(
            F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), *[F.first(f"up_{n}").alias(f"up_{n}") for n in LANES]
        )
        above = ["block", *[f"up_{n}" for n in LANES]]
        siblings = groups.groupBy(*above).agg(F.count("*").alias("siblings"))
        self.groups = keep_in(groups.join(siblings, above).withColumn("alone", F.col("siblings") == 1).drop("siblings"), "groups")
        self.members = keep_in(self._members(), "members")
        self.nodes = keep_in(self._nodes(), "nodes")

    def _members(self) -> DataFrame:
        """The turns of each group's smallest member, with the prefix at each turn and before it."""
        inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)  # BLOCK rows
        chosen = self.groups.select("conv_id", "block", "n", "alone", *[F.col(c).alias(f"g_{c}") for c in PREFIX], *[f"up_{n}" for n in LANES])
        rows = self.steps.join(chosen, ["conv_id", "block"])
        ends = {n: F.col(f"up_{n}") + F.sum(n).over(inside) for n in LANES}
        return rows.select(
            "conv_id", "block", "n", "alone", *[f"g_{c}" for c in PREFIX], "depth", "words", *[F.col(n).alias(f"own_{n}") for n in LANES],
            *[c.alias(n) for n, c in ends.items()],
        )

    def _merged(self, rows: DataFrame, **sums: str) -> DataFrame:
        """Node sums of `rows` (`alone`, the prefix, columns to sum): merged only where siblings diverge."""
        columns = [F.col(c).alias(n) for n, c in sums.items()]
        as_is = rows.filter("alone").select(*PREFIX, *columns)
        parted = rows.filter("not alone").groupBy(*PREFIX).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
        return as_is.unionByName(parted)

    def _nodes(self) -> DataFrame:
        """A row per node below the root: prefix, smallest member, members, words and the prefix above."""
        keep = ["words", *[f"own_{n}" for n in LANES]]
        as_is = self.members.filter("alone").select(*PREFIX, "conv_id", F.col("n").alias("n_convs"), *keep)
        parted = self.members.filter("not alone").groupBy(*PREFIX).agg(
            F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"), *[F.first(c).alias(c) for c in keep]
        )
        nodes = as_is.unionByName(parted).withColumn("up_depth", F.col("depth") - 1)
        return nodes.withColumns({f"up_{n}": F.col(n) - F.col(f"own_{n}") for n in LANES}).drop(*[f"own_{n}" for n in LANES])

    def over_members(self, weights: DataFrame, *names: str) -> DataFrame:
        """For every node the sums, over its members, of `weights` (`conv_id` and `names`)."""
        group = ["block", *PREFIX]
        heavy = self.blocks.join(weights, "conv_id").groupBy(*group).agg(*[F.sum(n).alias(n) for n in names])
        heavy = heavy.select("block", *[F.col(c).alias(f"g_{c}") for c in PREFIX], *names)
        rows = self.members.select("block", "alone", *[f"g_{c}" for c in PREFIX], *PREFIX).join(heavy, ["block", *[f"g_{c}" for c in PREFIX]])
        return self._merged(rows, **{n: n for n in names})


def _join_ids(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Sorted (keys, conv_id) in; (keys, first id, piece) out, pieces of up to PIECE characters."""
    at, first, ids, size, out = None, 0, [], 0, []
    names = [*keys, "first", "piece"]

    def table() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(x, pa.string() if n == "piece" else pa.int64()) for n, x in zip(names, zip(*out))], names)
        out.clear()
        return batch

    for batch in batches:
        for *key, conv in zip(*(batch.column(c).to_pylist() for c in [*keys, "conv_id"])):
            if ids and (key != at or size > PIECE):
                out.append((*at, first, ",".join(ids)))
                ids, size = [], 0
                if sum(len(x[-1]) for x in out[-64:]) > PIECE or len(out) >= 4096:
                    yield table()
            if not ids:
                at, first = key, conv
            ids.append(str(conv))
            size += len(ids[-1]) + 1
    if ids:
        out.append((*at, first, ",".join(ids)))
    if out:
        yield table()


def _hash_pieces(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces in; (keys, sha256 of the node's joined pieces) out."""
    at, state, out = None, None, []
    names = [*keys, "ends_sha256"]
    for batch in batches:
        for *key, piece in zip(*(batch.column(c).to_pylist() for c in [*keys, "piece"])):
            if key != at:
                if at is not None:
                    out.append((*at, state.hexdigest()))
                at, state = key, hashlib.sha256(piece.encode())
            else:
                state.update(b"," + piece.encode())
        if len(out) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names)
            out = []
    if at is not None:
        out.append((*at, state.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names)


def ends_digests(ends: DataFrame) -> DataFrame:
    """`depth`, lanes, `ends_sha256` from (`depth`, lanes, `conv_id`) of every conversation's end."""
    kinds = ", ".join(f"{c} long" for c in PREFIX)
    order = [*PREFIX, "conv_id"]
    sorted_ends = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = sorted_ends.mapInArrow(lambda b: _join_ids(b, PREFIX), f"{kinds}, first long, piece string")
    together = pieces.repartition(*PREFIX).sortWithinPartitions(*PREFIX, "first")
    return together.mapInArrow(lambda b: _hash_pieces(b, PREFIX), f"{kinds}, ends_sha256 string")


def prefix_trie(conversations: DataFrame, family: int = 20, most_heads: int = 4) -> DataFrame:
    """`conv_id`, `depth`, `parent_conv_id`, `n_convs`, `n_children`, `n_leaves`, `saved_tokens`,
    `ends_sha256` of every node, the root included."""
    convs, path = rebuilt(conversations, family, most_heads)
    convs = keep_in(convs, "rebuilt")
    trie = Trie(path)
    parents = _as_parent(trie.nodes.select(*PREFIX)).columns
    children = trie.nodes.groupBy(*parents).agg(F.count("*").alias("n_children"))
    children = children.select(*[F.col(c).alias(c.removeprefix("up_")) for c in parents], "n_children")
    nodes = trie.nodes.join(children, PREFIX, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    saved = (F.col("n_convs") - 1) * F.col("words")
    owned = keep_in(running_sums(nodes.withColumn("saved", saved), ["conv_id"], ["depth"], {"upto": F.col("saved")}), "owned")
    # What a member owns: the savings of its nodes, and whether it ends in a leaf of its own.
    weights = owned.groupBy("conv_id").agg(F.sum("saved").alias("owns"), F.count_if(F.col("n_children") == 0).alias("leaf"))
    weights = keep_in(weights.filter("owns > 0 or leaf > 0"), "weights")
    sums = trie.over_members(weights, "owns", "leaf")
    below = F.coalesce("owns", F.lit(0)) - (F.col("upto") - F.col("saved"))
    nodes = owned.join(sums, PREFIX, "left").withColumns({"saved_tokens": below, "n_leaves": F.coalesce("leaf", F.lit(0))})
    up = trie.nodes.select(*[F.col(c).alias(f"up_{c}") for c in PREFIX], F.col("conv_id").alias("_parent"))
    nodes = nodes.join(up, [f"up_{c}" for c in PREFIX], "left")

    zero = [F.lit(0).cast("long").alias(c) for c in PREFIX]
    whole = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    top = trie.nodes.filter("depth = 1").agg(F.count("*").alias("n_children"))
    total = weights.agg(F.coalesce(F.sum("owns"), F.lit(0)).alias("saved_tokens"), F.coalesce(F.sum("leaf"), F.lit(0)).alias("n_leaves"))
    sides = whole.unionByName(top, allowMissingColumns=True).unionByName(total, allowMissingColumns=True)
    root = sides.agg(*[F.max(c).alias(c) for c in sides.columns]).filter("conv_id is not null")
    root = root.withColumn("n_leaves", F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")))
    columns = ["conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    least = whole.first()
    parent = F.when(F.col("depth") == 1, F.lit(least["conv_id"] if least else None).cast("long")).otherwise(F.col("_parent"))
    rows = nodes.select(*PREFIX, *columns, parent.alias("parent_conv_id"))
    rows = rows.unionByName(root.select(*zero, *columns, F.lit(None).cast("long").alias("parent_conv_id")))

    last = trie.blocks.join(convs, "conv_id").filter("depth = n_turns").select(*PREFIX, "conv_id")
    ends = last.unionByName(convs.filter("n_turns = 0").select(*zero, "conv_id"))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    rows = rows.join(ends_digests(ends), PREFIX, "left")
    return rows.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )
