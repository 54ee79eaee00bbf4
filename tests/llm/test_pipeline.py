"""The pipeline, stage by stage, against plain versions on the smallest tables."""

import os
import subprocess
import sys

import corpus_pipeline
import plain
import pytest
from pyspark.sql import functions as F
from oracle import compare, connect
from test_files_and_vectors import check_packing

from stationflow.llm import boilerplate, importance
from stationflow.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_run(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = {r["doc_id"] for r in importance.importance(documents, labels).filter("kept").collect()}
    clean = {r["doc_id"] for r in labels.filter("quality = 1").collect()}
    junk = {r["doc_id"] for r in labels.filter("quality = 0").collect()}
    assert len(clean & kept) >= 0.97 * len(clean) and not junk & kept
    rows = [(r["doc_id"], r["text"], r["source"]) for r in documents.collect() if r["doc_id"] in kept]
    rows = plain.cut_lines(rows, boilerplate.RATIO, boilerplate.MIN_PAGES)
    ids, texts = [r[0] for r in rows], [r[1] for r in rows]
    groups = plain.components(len(rows), plain.jaccard_links(texts, 5, 80))
    rows = [r for r, g in zip(rows, groups, strict=True) if r[0] == plain.least(ids, g)]
    items = [plain.words(r["text"], lower=True) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    def leaks(text):
        own = plain.words(text, lower=True)
        runs = {tuple(own[i : i + 5]) for i in range(len(own) - 4)}
        tried = [x for x in items if len(x) >= 5 and any(tuple(x[i : i + 5]) in runs for i in range(len(x) - 4))]
        return any(plain.tiled(x, own, 5) >= 0.5 * len(x) for x in tried)
    rows = [r for r in rows if not leaks(r[1])]
    assert 0 < len(rows) < len(kept)
    check_packing([(i, t) for i, t, _ in rows], corpus_pipeline.run(spark, SF).collect(), 1024)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes, name


def test_stages_of_odd_rows(spark, odd, empty):
    """With further columns, some named as those that the stages make."""
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, odd, SF)
        assert after.count() > 0
        assert name == "packing" or after.columns == odd.columns, name
        assert stage(spark, empty, SF).count() == 0


def test_stages_of_long_texts(spark, rng):
    """Texts beyond the slices that tasks hold at a time."""
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(700_000))
    docs = spark.createDataFrame([(1, long + " end", "en", "a", 0), (2, long + " other end", "en", "a", 0), (3, "short", "en", "a", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    assert len(long) > 4 << 20
    left = {name: stage(spark, docs, SF) for name, stage in corpus_pipeline.STAGES[1:]}
    assert left["line dedup"].count() == left["benchmark decontamination"].count() == 3
    assert sorted(r[0] for r in left["n-gram Jaccard join"].select("doc_id").collect()) == [1, 3]
    tokens = left["packing"].groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("tokens")).collect()
    assert len(tokens) == 3 and all(r["n"] == r["tokens"] for r in tokens)


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    same, _, difference = compare(QUERIES[name](spark, SF), connect(SF), SQL[name])
    assert same, difference


def test_the_rest_stands_alone(tmp_path):
    """Without these folders and the pipeline the entry still imports."""
    for name in ("stationflow", "__spark_entry__.py"):
        subprocess.run(["cp", "-r", f"{ROOT}/{name}", str(tmp_path)], check=True)
    os.rename(tmp_path / "stationflow" / "llm", tmp_path / "apart")
    code = "import __spark_entry__ as e; assert e.queries() and not any(n.startswith('op') or n == 'pipeline' for n in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, check=True)


def test_all_operators_and_the_pipeline_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} >= set(range(1, 14)) and "pipeline" in names
