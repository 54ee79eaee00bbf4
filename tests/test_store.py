"""The store: loads that count as a whole or not at all."""

import os
import subprocess
import sys

import pytest
from fixtures import UTILITY, frames, rows
from pyspark.sql import functions as F

from stationflow.operators.updates import new
from stationflow.plans import utility
from stationflow.plans.common import run_into
from stationflow.sinks.store import ConflictError, IntegrityError, Store


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def put(store, **tables):
    with store.begin() as load:
        for name, table in tables.items():
            load.put(name, table)
        load.commit()


def files(store, table):
    return {
        os.path.relpath(os.path.join(d, f), store.folder)
        for d, _, names in os.walk(f"{store.folder}/{table}") for f in names if f.startswith("part-") and "/directory" not in d
    }


def test_nothing_counts_before_the_commit(spark, store):
    assert store.table("a") is None and store.manifest().version == 0
    put(store, a=spark.range(3).toDF("id"), b=spark.range(3).toDF("id"))
    failing = spark.range(5).select(F.raise_error(F.lit("broken")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"), store.begin() as load:
        load.put("a", spark.range(9).toDF("id"))
        assert load["a"].count() == 9 and store.table("a").count() == 3
        load.put("b", failing)
    assert rows(store.table("a")) == rows(store.table("b")) == [(0,), (1,), (2,)]
    with store.begin() as load:  # left without a commit
        load.put("a", load["a"].where("id > 0"))
    assert store.table("a").count() == 3 and store.manifest().version == 1
    assert len(os.listdir(f"{store.folder}/a")) == 1


KILLED = """
import os, sys
sys.path[:0] = [{repo!r}]
from stationflow.session import local_session
from stationflow.sinks.store import Store
spark = local_session("2")
load = Store(spark, {folder!r}).begin()
load.put("a", spark.range(100).toDF("id"))
os._exit(9)
"""


def test_killed_between_two_tables(spark, store):
    put(store, a=spark.range(3).toDF("id"), b=spark.range(3).toDF("id"))
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    run = subprocess.run([sys.executable, "-c", KILLED.format(repo=repo, folder=store.folder)], capture_output=True, timeout=300)
    assert run.returncode == 9
    assert len(os.listdir(f"{store.folder}/a")) == 2  # what the killed load left
    assert store.table("a").count() == store.table("b").count() == 3 and store.manifest().version == 1
    put(store, b=spark.range(4).toDF("id"))
    assert store.table("a").count() == 3 and store.table("b").count() == 4
    assert len(os.listdir(f"{store.folder}/a")) == 1


def test_of_two_loads_one_counts(spark, store):
    put(store, a=spark.range(3).toDF("id"))
    with store.begin() as one, store.begin() as other:
        one.put("a", spark.range(4).toDF("id"))
        other.put("a", spark.range(5).toDF("id"))
        other.commit()
        with pytest.raises(ConflictError):
            one.commit()
    assert store.table("a").count() == 5 and store.versions() == [1, 2]


def test_kept_states(spark, store):
    for n in range(1, 6):
        put(store, a=spark.range(n).toDF("id"))
    assert store.versions() == [4, 5] and len(os.listdir(f"{store.folder}/a")) == 2
    assert store.table("a", version=4).count() == 4


def checked(tables):
    return tables["b"].join(tables["a"], "id", "left_anti").agg(F.lit("b.id").alias("reference"), F.count("*").alias("violations"))


def test_checks(spark, store):
    put(store, a=spark.range(3).toDF("id"))
    for dry_run in (True, False):
        with store.begin() as load:
            load.put("b", spark.range(5).toDF("id"))
            if dry_run:
                assert load.commit(checked, dry_run=True) == {"b.id": 2}
            else:
                with pytest.raises(IntegrityError) as error:
                    load.commit(checked)
                assert error.value.violations == {"b.id": 2}
        assert store.table("b") is None and not os.path.exists(f"{store.folder}/b/{load._folder}-1")
    with store.begin() as load:
        load.put("b", spark.range(2).toDF("id"))
        assert load.commit(checked) == {}
    assert store.table("b").count() == 2


def test_merge_leaves_other_files(spark, store):
    first = spark.range(2000).select("id", F.concat(F.lit("v"), "id").alias("v"), F.lit(7).alias("depth"))
    with store.begin() as load:
        load.replace("t", "id", first, bucket_rows=100)
        load.commit()
    buckets = {r["bits"]: r["rows"] for r in store.buckets("t").collect()}
    assert max(buckets.values()) <= 100 and store.buckets("t").agg(F.sum("rows")).first()[0] == 2000
    before = files(store, "t")
    changes = spark.createDataFrame([(5, "x"), (5, "w"), (6, None), (5000, "new")], "id int, v string")
    with store.begin() as load:
        load.merge("t", "id", changes, {"v": new("v")})
        load.commit()
    after = files(store, "t")
    assert len(before - after) <= 3 and len(before & after) >= len(before) - 3
    found = {r["id"]: (r["v"], r["depth"]) for r in store.table("t").collect()}
    assert len(found) == 2001
    assert (found[5], found[6], found[5000], found[7]) == (("w", 7), (None, 7), ("new", None), ("v7", 7))
    with store.begin() as load:
        load.delete("t", "id", spark.range(100, 3000).toDF("id"))
        load.delete("t", "id", spark.range(9_000_000, 9_000_001).toDF("id"))
        load.commit()
    assert store.table("t").count() == 101
    with store.begin() as load:
        load.delete("t", "id", load["t"])
        load.commit()
    assert store.table("t").count() == 0
    with store.begin() as load:
        load.replace("t", "id", first.where("id < 10"))
        load.commit()
    assert store.table("t").count() == 10


def test_frequent_key(spark, store):
    """A key with a third of all rows is a bucket of its own, in several files."""
    hot = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("id"), F.col("id").alias("v"))
    with store.begin() as load:
        load.replace("t", "id", hot, bucket_rows=50)
        load.commit()
    sizes = sorted(r["rows"] for r in store.buckets("t").collect())
    assert sizes[-1] == 1000 and sizes[-2] <= 50 and sum(sizes) == 3000
    assert rows(store.table("t")) == rows(hot)
    with pytest.raises(Exception, match="without id"), store.begin() as load:
        load.replace("t", "id", spark.createDataFrame([(None, 1)], "id long, v long"))
    with pytest.raises(ValueError), store.begin() as load:
        load.replace("t", "v", hot)


def test_sequences(spark, store):
    put(store, a=spark.createDataFrame([(3,), (8,)], "id int"))
    with store.begin() as load:
        assert load.reserve("a", 2) == 9 and load.reserve("b", 1) == 1
        numbered = load.number("a", spark.createDataFrame([("y",), ("x",)], "v string"), ["v"])
        assert rows(numbered) == [("x", 11), ("y", 12)]
        load.observe("b", spark.createDataFrame([(20,), (None,)], "id int"))
        load.commit()
    put(store, a=store.table("a").limit(0))
    assert store.manifest().marks == {"a": 13, "b": 21}


def test_plan_into_store(spark, tmp_path):
    """The same plan twice on one store: ids go on, and a broken source changes nothing."""
    codes = {1: "service_code", 2: "miet_code"}
    source = frames(spark, UTILITY)
    types = spark.createDataFrame([(1, "a", "a"), (2, "b", "b")], "id int, descr string, descr_alt string")
    folder = str(tmp_path / "store")
    seeds = {
        "gentity": spark.createDataFrame([(453,)], "id int"), "garea": spark.createDataFrame([(453,), (507,)], "gentity_ptr_id int"),
    }
    plain = utility.load(spark, source, types, codes, "imported_file_", seeds)
    found = run_into(spark, folder, lambda load: utility.load(spark, source, types, codes, "imported_file_", load), dry_run=True)
    assert found and Store(spark, folder).manifest().version == 0
    with pytest.raises(IntegrityError):
        run_into(spark, folder, lambda load: utility.load(spark, source, types, codes, "imported_file_", load))
    store = Store(spark, folder)
    assert store.table("gentity") is None
    with store.begin() as load:
        for name, table in utility.load(spark, source, types, codes, "imported_file_", load).items():
            load.put(name, table)
        load.commit()
    assert rows(store.table("gentityaltcode")) == rows(plain["gentityaltcode"])
    marks = store.manifest().marks
    top = store.table("gentityaltcode").agg(F.max("id")).first()[0]
    assert marks["gentityaltcode"] == top + 1
    with store.begin() as load:
        more = utility.load(spark, source, types, codes, "imported_file_", load)["gentityaltcode"]
        assert more.agg(F.max("id")).first()[0] == 2 * top
