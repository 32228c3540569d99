"""The pipeline's stages, each against what its operator promises."""

from collections import Counter

import pytest

import corpus_pipeline
from genoweave.llm import rules
from genoweave.llm.queries import QUERIES
from test_near_copies import first_ids

COLUMNS = corpus_pipeline.COLUMNS


@pytest.fixture(scope="module")
def folder(tmp_path_factory, docs, spark):
    path = tmp_path_factory.mktemp("tables")
    prose = " ".join(f"word{k} of the" for k in range(40))
    more = [(100 + k, f"{prose} {k} and more words here {k * 7} in the end", "en", "s", 1) for k in range(4)]
    shared = " ".join(f"shared{k} to the" for k in range(20))
    more += [(200 + k, " ".join(f"own{k}x{j} and the" for j in range(60)) + " " + shared, "en", "s", 1) for k in range(3)]
    more += [(300 + k, " ".join(f"bad{k}x{j} and the" for j in range(30)) + (" scum" if k % 2 else ""), None, None, None) for k in range(120)]
    docs.select(*COLUMNS).union(spark.createDataFrame(more, docs.select(*COLUMNS).schema)).write.parquet(str(path / "documents.parquet"))
    labels = [(300 + k, k % 2, 1) for k in range(120)]
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(str(path / "labels.parquet"))
    return str(path)


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    outputs = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        outputs.append(docs)
        assert k == 4 or docs.columns == COLUMNS, name
    good, mild, single, cut, packed = outputs
    every = spark.read.parquet(f"{folder}/documents.parquet")
    assert good.count() == rules.judge(every, "doc_id").filter("kept").count()
    mild_ids = {r["doc_id"] for r in mild.collect()}
    assert all((300 + k in mild_ids) == (k % 2 == 0) for k in range(120))
    assert {100, 200, 201, 202} <= mild_ids
    # Rows of one id and other texts get a number each for the comparison.
    rows = sorted({(r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in mild.collect()})
    assert single.count() == len(first_ids({k: r[2] for k, r in enumerate(rows)}))
    texts = {r["doc_id"]: r for r in cut.collect()}
    assert len(texts) == single.select("doc_id").distinct().count()
    assert "shared3" in texts[200]["text"] and "shared3" not in texts[201]["text"] and "own2x5" in texts[202]["text"]
    assert texts[201]["n_chars"] == len(texts[201]["text"])
    assert Counter(r["doc_id"] for r in packed.filter("piece = 0").collect()) == Counter(r["doc_id"] for r in cut.collect())


def test_run_is_the_stages(spark, folder):
    assert corpus_pipeline.run(spark, folder).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, toxic int, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered():
    assert sorted(int(x[2:].split("_")[0]) for x in QUERIES) == list(range(1, 14))
