import pytest
from pyspark.sql import functions as F

from genoweave.functions.text import list_text, text_list
from genoweave.operators import lists
from genoweave.operators.positions import row_numbers, running_position

SMALL = [
    (0, "rs14160", "0/0", "LRRD1"), (1, "rs14161", "0/0", "LRRD1"), (2, "rs14162", "0/0", "LRRD3"),
    (3, "rs14164", "0/0", "LRRD2"), (4, "rs14161", "0/0", "LRRD2"), (5, "rs14160", "0/0", "LRRD4"),
]
SCHEMA = "at int, id string, szpabr0002 string, gene_name string"


def hot_rows(spark, n=3000):
    """Group 'hot' holds a third of the rows, the rest spreads over many groups."""
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 97))
    return spark.range(n).select(key.alias("gene"), F.format_string("rs%05d", "id").alias("rsid"),
                                 (F.col("id") % 7 + 1).alias("n"))


def test_positions_match_a_plain_count(spark):
    rows = running_position(hot_rows(spark), ["gene"], ["rsid"], "at").collect()
    assert len(rows) == 3000
    expected = {}
    for r in sorted(rows, key=lambda r: r.rsid):
        assert r["at"] == expected.get(r.gene, 0)
        expected[r.gene] = expected.get(r.gene, 0) + 1


def test_weighted_positions(spark):
    rows = running_position(hot_rows(spark), ["gene"], ["rsid desc"], "at", "n").collect()
    total = {}
    for r in sorted(rows, key=lambda r: r.rsid, reverse=True):
        assert r["at"] == total.get(r.gene, 0)
        total[r.gene] = total.get(r.gene, 0) + r.n


def test_dense_positions(spark):
    twice = hot_rows(spark).unionByName(hot_rows(spark))
    rows = running_position(twice, ["gene"], ["rsid"], "at", dense=True).collect()
    assert len(rows) == 6000
    seen = {}
    for r in rows:
        seen.setdefault(r.gene, {}).setdefault(r.rsid, set()).add(r["at"])
    for ids in seen.values():
        assert [ids[i] for i in sorted(ids)] == [{n} for n in range(len(ids))]


def test_global_row_numbers(spark):
    rows = row_numbers(hot_rows(spark), [], ["n desc", "rsid"]).collect()
    ordered = sorted(rows, key=lambda r: (-r.n, r.rsid))
    assert [r.row for r in ordered] == list(range(1, 3001))


def test_groups_with_a_missing_key_count_too(frame):
    df = frame("gene string, rsid string", (None, "a"), (None, "b"), ("x", "c"))
    rows = running_position(df, ["gene"], ["rsid"], "at").collect()
    assert {(r.gene, r.rsid, r["at"]) for r in rows} == {(None, "a", 0), (None, "b", 1), ("x", "c", 0)}


def test_no_window_over_the_rows_of_a_whole_group(spark):
    text = running_position(hot_rows(spark), [], ["rsid"], "at")._jdf.queryExecution().executedPlan().toString()
    assert "_segment" in text.split("Window")[1].split("\n")[0]


def test_lists_in_input_order(frame):
    df = frame(SCHEMA, *SMALL)
    rows = lists.group_arrays(df, ["gene_name"], "id", ["at"], "ids").collect()
    assert {r.gene_name: r.ids for r in rows} == {
        "LRRD1": ["rs14160", "rs14161"], "LRRD2": ["rs14164", "rs14161"], "LRRD3": ["rs14162"],
        "LRRD4": ["rs14160"]}


def test_lists_keep_duplicates(frame):
    df = frame("gene_name string, id string", ("LRRD1", "rs14160"), ("LRRD1", "rs14160"))
    row = lists.group_lists(df, ["gene_name"], "id", "ids").first()
    assert (row.page, row.ids) == (0, "['rs14160', 'rs14160']")


def test_pages_hold_the_whole_list(spark):
    df = hot_rows(spark).select("gene", (F.col("n") * 1000).cast("string").alias("id"))
    pages = lists.paged_runs(df, ["gene"], "id", ",", "ids", page_items=40).collect()
    wanted = {}
    for r in df.collect():
        wanted.setdefault(r.gene, []).append(r.id)
    found = {}
    for r in sorted(pages, key=lambda r: (r.gene, r.page)):
        part = r.ids.split(",")
        assert len(part) <= 40
        found.setdefault(r.gene, []).extend(part)
    assert found == {gene: sorted(ids) for gene, ids in wanted.items()}


def test_lists_beside_their_rows(frame):
    rows, texts = lists.rows_and_lists(frame(SCHEMA, *SMALL), "gene_name", "id", ["at"], "ids")
    assert rows.count() == 6 and {r.pages for r in rows.collect()} == {1}
    assert {(r.gene_name, r.ids) for r in lists.with_lists(rows, texts, "gene_name").collect()} == {
        ("LRRD1", "['rs14160', 'rs14161']"), ("LRRD2", "['rs14164', 'rs14161']"),
        ("LRRD3", "['rs14162']"), ("LRRD4", "['rs14160']")}


def test_no_page_of_a_list_is_lost(spark):
    ids = F.when(F.col("id") < 250, "a").otherwise("b")
    df = spark.range(260).select(F.col("id").alias("at"), ids.alias("v"), F.lit("g").alias("gene"))
    rows, texts = lists.rows_and_lists(df, "gene", "v", ["at"], "ids", page_items=100)
    assert {r.pages for r in rows.collect()} == {3}
    assert [r.ids.count("'") // 2 for r in texts.orderBy("page").collect()] == [100, 100, 60]
    assert lists.with_lists(rows, texts, "gene").count() == 3 * 260


def test_rows_of_one_list_lie_together(spark, tmp_path):
    df = spark.range(3000).select(F.col("id").alias("at"), F.col("id").cast("string").alias("v"), (F.col("id") % 150).cast("string").alias("gene"))
    df = df.withColumn("v", F.concat("v", F.lit("_" * 500))).orderBy("at")
    rows, texts = lists.rows_and_lists(df, "gene", "v", ["at"], "ids", page_items=10)
    joined = lists.with_lists(rows, texts, "gene")
    assert joined.columns == ["gene", "at", "v", "pages", "page", "ids"]
    joined.write.parquet(str(tmp_path / "joined"))
    written = spark.read.parquet(str(tmp_path / "joined"))
    assert written.count() == 2 * 3000
    part = written.withColumn("file", F.input_file_name()).withColumn("at_file", F.monotonically_increasing_id())
    runs = part.selectExpr("file", "ids", "lag(ids) over (partition by file order by at_file) as before").filter("ids is distinct from before")
    assert runs.count() == 150 * 2


def test_distinct_concat_of_every_column(frame):
    df = frame(SCHEMA, *SMALL).drop("at")
    rows = {r.gene_name: (r.id, r.szpabr0002) for r in lists.distinct_concat(df, "gene_name").collect()}
    assert rows == {
        "LRRD1": ("rs14160rs14161", "0/0"), "LRRD2": ("rs14161rs14164", "0/0"),
        "LRRD3": ("rs14162", "0/0"), "LRRD4": ("rs14160", "0/0")}


def test_ids_by_gene(frame):
    df = frame(SCHEMA, *SMALL).withColumnRenamed("id", "rsid")
    rows = {r.gene_name: r.rsids for r in lists.ids_by_gene(df, " ").collect()}
    assert rows["LRRD2"] == "rs14161 rs14164"
    paged = lists.ids_by_gene(df, ",", page_items=1).orderBy("gene_name", "page").collect()
    assert [(r.gene_name, r.page, r.rsids) for r in paged][:2] == [("LRRD1", 0, "rs14160"), ("LRRD1", 1, "rs14161")]


ENTRIES = ["a, b", "c", "it's", 'say "x"', "both ' and \"", "back\\slash", "\\", "\\n", "line\nfeed\ttab\r", "", "None", None, "', '", "[x]", "é🙂", "\\'"]


def test_list_text_of_any_entries(frame):
    df = frame("v array<string>", (ENTRIES,), (ENTRIES[:1],), ([None],), ([None, "x"],), ([],), (None,))
    rows = df.select("v", list_text(F.col("v")).alias("t")).select("v", "t", text_list(F.col("t")).alias("w")).collect()
    assert all(r.v == r.w for r in rows)
    assert all(r.t == repr(r.v) for r in rows if r.v is not None)
    assert rows[0].t.startswith("['a, b', 'c', \"it's\", ")


def test_long_list_texts(frame):
    many = [f"rs{k} it's" if k % 3 else f"rs{k}\\" for k in range(10_000)] + ["x'\"" * 20_000]
    row = frame("v array<string>", (many,)).select(text_list(list_text(F.col("v"))).alias("w")).first()
    assert row.w == many


def test_texts_that_are_no_lists(frame):
    bad = ["", "[", "[a]", "['a'", "['a','b']", "['a', ]", "['a' 'b']", "['it's']", "x['a']", "None"]
    assert all(r[0] is None for r in frame("t string", *[(x,) for x in bad]).select(text_list(F.col("t"))).collect())


def test_list_text_round_trip(frame):
    df = frame("v array<string>", (["a", "b"],), (["a"],), ([],))
    back = df.select("v", text_list(list_text(F.col("v"))).alias("w")).collect()
    assert all(r.v == r.w for r in back)
    bad = frame("t string", ("no list",)).select(text_list(F.col("t"))).first()[0]
    assert bad is None
