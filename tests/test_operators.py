import datetime as dt
import glob

import pytest
from fixtures import rows
from pyspark.sql import functions as F

from stationflow.operators.documents import ordered_parts, ordered_text
from stationflow.operators.ids import assign_ids, next_ids
from stationflow.operators.joins import carry_records, match_time_steps, members, not_in
from stationflow.operators.skew import one_per_key
from stationflow.operators.tables import append, split_entity, tagged_rows
from stationflow.operators.updates import get_or_create, new, update_from
from stationflow.plans.national import unit_variables
from stationflow.sinks.files import write_blobs, write_series_dir
from stationflow.sinks.tables import read_series, store_tables, stored_table, write_series
from stationflow.sources.copytext import read_copy_dump, read_copy_text, write_copy_text
from stationflow.sources.seriesdir import read_series_lines
from stationflow.sources.tables import snapshot_names


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial")[0]


@pytest.fixture
def no_broadcast(spark):
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(spark, n=60_000):
    """A third of all rows share key 7."""
    return spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")
    )


def test_frequent_keys_are_split(spark, no_broadcast):
    left = hot(spark)
    right = spark.range(0, 60_000, 1, 4).select((F.col("id") % 1000).alias("key"), F.col("id").alias("x"))
    for joined in (
        members(left, "k", right, "key"),
        not_in(left, "k", right.where("key <> 7"), "key"),
        update_from(left, right, {"k": "key"}, {"v": new("x").cast("string")}),
    ):
        plan = final_plan(joined)
        assert "skew=true" in plan, plan
        assert "NestedLoop" not in plan
    # The unique side comes partitioned by the key of the join.
    lists = right.groupBy("key", "x").agg(F.count("*").alias("n")).repartition("key")
    joined = left.join(one_per_key(lists, ["key"], F.collect_list("x").alias("xs")), F.col("k") == F.col("key"), "left")
    assert "skew=true" in final_plan(joined)
    assert members(left, "k", right, "key").count() == sum(1 for i in range(60_000) if i % 3 == 0 or i < 1000)


def test_update_from(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3), (None, "d", 4)], "id int, t string, n int")
    source = spark.createDataFrame([(1, None, 9), (2, "y", 2), (2, "x", 1), (None, "z", 0)], "k int, u string, o int")
    updated = update_from(target, source, {"id": "k"}, {"t": F.concat(new("u"), F.col("t"))}, order=["o"])
    assert rows(updated) == [(None, "d", 4), (1, None, 1), (2, "xb", 2), (3, "c", 3)]
    with pytest.raises(ValueError):
        update_from(target, source, {"id": "k"}, {"missing": new("u")})


def test_not_in(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    keys = lambda *v: spark.createDataFrame([(x,) for x in v], "b int")
    assert rows(not_in(left, "a", keys(1), "b")) == [(2,)]
    assert rows(not_in(left, "a", keys(1, None), "b")) == []
    assert rows(not_in(left, "a", keys(), "b")) == [(None,), (1,), (2,)]


def test_assign_ids(spark):
    df = hot(spark, 5000)
    numbered = assign_ids(df, ["k", "v"], 11, unique=True).collect()
    expected = sorted((r["k"], r["v"]) for r in df.collect())
    assert [(r["k"], r["v"]) for r in sorted(numbered, key=lambda r: r["id"])] == expected
    assert sorted(r["id"] for r in numbered) == list(range(11, 5011))
    copies = spark.range(30_000).select(F.lit("a").alias("x"))
    ids = assign_ids(copies, ["x"]).agg(F.min("id"), F.max("id"), F.countDistinct("id")).collect()[0]
    assert tuple(ids) == (1, 30_000, 30_000)
    empty = spark.createDataFrame([], "id int")
    assert rows(next_ids({"t": empty})) == [("t", 1)]
    assert rows(next_ids({"t": empty}, empty=None)) == [("t", None)]


def documents_of(df):
    expected = {}
    for r in sorted(df.collect(), key=lambda r: (r["k"], r["v"])):
        expected.setdefault(r["k"], []).append(r["v"])
    return expected


def test_large_documents(spark):
    df = hot(spark, 4000).unionByName(spark.createDataFrame([(7, "copy")] * 25, "k bigint, v string"))
    expected = documents_of(df)
    texts = ordered_text(df, ["k"], ["v"], F.col("v"), extra={"n": F.count("*")}).collect()
    assert {r["k"]: (r["content"], r["n"]) for r in texts} == {k: ("\n".join(v), len(v)) for k, v in expected.items()}


def test_rows_by_file_and_place_are_never_broadcast(spark, tmp_path):
    """A file's path stands in each row; small as such tables look to the planner, a task would hold them whole."""
    spark.range(0, 2000, 1, 3).write.parquet(str(tmp_path / "t"))
    numbered = assign_ids(spark.read.parquet(str(tmp_path / "t")), ["id"], name="n", unique=True)
    joins = [line for line in final_plan(numbered).splitlines() if "Join" in line and "_file" in line]
    assert joins and all("SortMergeJoin" in line for line in joins), joins
    assert numbered.where("n <> id + 1").isEmpty() and numbered.count() == 2000


def test_carried_chunks_are_not_sorted(spark, no_broadcast):
    chunks = spark.range(0, 6000, 1, 3).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100).alias("id"), F.lit(None).cast("string").alias("top"), F.lit("m").alias("middle"), F.lit("b").alias("bottom"))
    series = spark.createDataFrame([(1007, 7), (1008, 8), (2008, 8), (1, None)], "id long, old long")
    carried = carry_records(chunks, series, old_id="old")
    plan = final_plan(carried)
    assert "ShuffledHashJoin" in plan and "Sort [" not in plan, plan
    want = {}
    for i in range(6000):
        old = 7 if i % 3 == 0 else i % 100
        for new_id in {7: (1007,), 8: (1008, 2008)}.get(old, ()):
            want[new_id] = want.get(new_id, 0) + 1
    assert {r["id"]: r["count"] for r in carried.groupBy("id").count().collect()} == want


@pytest.mark.parametrize("part_bytes", [1, 100, 5000, 1 << 26])
def test_document_parts(spark, no_broadcast, part_bytes):
    """A part follows from the bytes before a line, not from partitions."""
    df = hot(spark, 3000).unionByName(spark.createDataFrame([(7, "copy")] * 25 + [(None, "null key"), (7, None)], "k bigint, v string"))
    expected = {}
    for k, lines in documents_of(df.where("k IS NOT NULL AND v IS NOT NULL")).items():
        before = 0
        for line in lines:
            expected.setdefault((k, before // part_bytes + 1), []).append(line)
            before += len(line) + 1
    expected[None, 1] = ["null key"]
    expected = {k: "\n".join(v) for k, v in expected.items()}
    for partitions in ("2", "64"):
        size = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        parts = ordered_parts(df, ["k"], ["v"], F.col("v"), part_bytes=part_bytes).collect()
        spark.conf.set("spark.sql.shuffle.partitions", size)
        assert {(r["k"], r["part"]): r["content"] for r in parts} == expected


def test_null_order_is_last(spark):
    df = spark.createDataFrame([(1, None, "last"), (1, 2, "b"), (1, 1, "a")], "k int, o int, v string")
    assert rows(ordered_text(df, ["k"], ["o"], F.col("v"), sep=",")) == [(1, "a,b,last")]
    assert rows(ordered_parts(df, ["k"], ["o"], F.col("v"), sep=",")) == [(1, 1, "a,b,last")]


def test_series_files(spark, tmp_path):
    start = dt.datetime(2000, 1, 1)
    data = [(i % 3 if i % 2 else 5, start + dt.timedelta(hours=7 * ((i * 37) % 500)), f"line{i:04d}") for i in range(500)]
    lines = spark.createDataFrame(data, "id int, ts timestamp_ntz, line string").repartition(5)
    expected = {}
    for i, t, line in sorted(data):
        expected.setdefault(i, []).append(line)
    for period in (None, F.date_format("ts", "yyyyMM")):
        out = str(tmp_path / f"series{period is None}")
        written = write_series_dir(lines, out, period=period)
        assert written.rows == 500
        found = {}
        for name in sorted(glob.glob(out + "/*.data")):
            found.setdefault(int(name.rsplit("/", 1)[1].split(".")[0]), []).append(open(name, "rb").read())
        assert {k: b"".join(v) for k, v in found.items()} == {
            k: "".join(line + "\r\n" for line in v).encode() for k, v in expected.items()
        }
        assert written.files == sum(len(v) for v in found.values())
        assert (max(len(v) for v in found.values()) == 1) == (period is None)
        assert rows(read_series_lines(spark, out)) == sorted((i, line) for i, _, line in data)


def test_blobs_need_names_of_their_own(spark, tmp_path):
    df = spark.createDataFrame([("a", "1"), ("b", "2"), ("a", "3"), ("c", None), ("c", ""), (None, "4")], "n string, b string")
    with pytest.raises(ValueError, match="2 rows for the file a"):
        write_blobs(df, str(tmp_path / "blobs"), F.col("n"), "b")
    assert write_blobs(df.where("b <> '3'"), str(tmp_path / "blobs"), F.col("n"), "b") == (2, 2)
    assert sorted(p.name for p in (tmp_path / "blobs").iterdir()) == ["a", "b"]


def test_files_show_all_at_once(spark, tmp_path):
    """A task that fails after others have written leaves the folder as it was."""
    folder = tmp_path / "files"
    folder.mkdir()
    rows_ = spark.range(0, 50, 1, 5).select(F.format_string("%d", "id").alias("n"), F.lit("text").alias("b"), "id")
    late = F.when(F.col("id") == 49, F.raise_error(F.reflect(F.lit("java.lang.Thread"), F.lit("currentThread")))).otherwise(F.col("b"))
    with pytest.raises(Exception):
        write_blobs(rows_.withColumn("b", late), str(folder), F.col("n"), "b")
    assert [p.name for p in tmp_path.iterdir()] == ["files"] and not list(folder.iterdir())
    with pytest.raises(Exception):  # a name that is no file's
        write_blobs(rows_.withColumn("n", F.when(F.col("id") == 49, "x/y").otherwise(F.col("n"))), str(folder), F.col("n"), "b")
    assert [p.name for p in tmp_path.iterdir()] == ["files"] and not list(folder.iterdir())
    assert write_blobs(rows_, str(folder), F.col("n"), "b") == (50, 50)
    lines = rows_.select(F.lit(1).alias("id"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"), late.alias("line"))
    with pytest.raises(Exception):
        write_series_dir(lines, str(folder), mode="overwrite")
    assert len(list(folder.iterdir())) == 50
    with pytest.raises(FileExistsError):
        write_blobs(rows_, str(folder), F.col("n"), "b")


def test_series_file_of_many_tasks(spark, no_broadcast, tmp_path):
    """One series with all rows: several tasks write its pieces, and it is one file."""
    lines = spark.range(0, 20_000, 1, 6).select(
        F.lit(7).alias("id"), F.timestamp_seconds(F.col("id") * 97 % 20_000).cast("timestamp_ntz").alias("ts"), F.format_string("%06d", F.col("id") * 97 % 20_000).alias("line")
    )
    assert write_series_dir(lines, str(tmp_path / "out"), part_bytes=10_000) == (1, 20_000)
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["00007.data"]
    assert (tmp_path / "out" / "00007.data").read_bytes() == b"".join(b"%06d\r\n" % i for i in range(20_000))
    pieces = ordered_parts(lines, ["id"], ["ts"], F.col("line"), part_bytes=10_000)
    assert pieces.select(F.spark_partition_id().alias("p")).distinct().count() > 4


def test_split_in_one_pass(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    tables = split_entity(df, {"x": {"id": "k", "v": "v"}, "y": {"id": F.col("k").cast("long"), "n": 5}, "z": {}})
    assert rows(tables["x"]) == [(1, "a"), (2, None)] and rows(tables["y"]) == [(1, 5), (2, 5)]
    assert tables["x"].dtypes == [("id", "int"), ("v", "string")] and tables["y"].dtypes == [("id", "bigint"), ("n", "int")]
    assert split_entity(df.limit(0), {"x": {"id": "k"}, "y": {"id": "k"}})["y"].count() == 0
    with pytest.raises(ValueError):
        tagged_rows(df, {"x": {"id": "k"}, "y": {"id": "v"}})


def test_ids_stage_no_payload(spark, tmp_path):
    """Rows of files keep their payload there: only places are sorted and written."""
    from stationflow import session

    spark.range(0, 5000, 1, 5).select("id", F.repeat(F.sha2(F.col("id").cast("string"), 256), 20).alias("text")).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    before = len(session._FOLDERS)
    numbered = assign_ids(table.where("id % 2 = 0"), ["id"], name="n")
    staged = [f for _, f in session._FOLDERS[before:]]
    assert len(staged) == 1 and spark.read.parquet(staged[0]).columns == ["_file", "_row", "_place"]
    assert [tuple(r) for r in numbered.orderBy("id").select("id", "n").collect()] == [(2 * i, i + 1) for i in range(2500)]
    joined = assign_ids(table.join(spark.range(2).toDF("k")), ["k", "id"], name="n")
    assert joined.agg(F.countDistinct("n"), F.max("n")).first()[:] == (10_000, 10_000)


def test_locations(spark):
    from stationflow.sinks.files import _location

    assert _location(spark, "s3a://store/x") == "s3://store/x" and _location(spark, "hdfs://store/x") == "hdfs://store/x"
    assert _location(spark, "/x") == "/x" and _location(spark, "file:///x") == "/x"


def test_series_store(spark, tmp_path):
    path = str(tmp_path / "store")
    t = dt.datetime(2000, 1, 1)
    first = spark.createDataFrame([(i, t, float(i), "") for i in range(200)], "id int, ts timestamp_ntz, value double, flags string")
    write_series(first, path, bucket_rows=30)
    for other in (30, 3, 1000):
        changed = read_series(spark, path).where("id in (3, 4)").withColumn("value", F.lit(-1.0))
        write_series(changed, path, bucket_rows=other)
        stored = read_series(spark, path)
        assert stored.count() == 200
        assert rows(stored.where("value < 0"), "id") == [(3,), (4,)]
    with pytest.raises(Exception, match="without id"):
        write_series(first.withColumn("id", F.lit(None).cast("int")), path)


def test_stored_versions(spark, tmp_path):
    """Loading twice onto one place keeps each row once, also after a failed run."""
    out = str(tmp_path / "tables")
    assert stored_table(spark, out, "t") is None
    for run in range(4):
        have = stored_table(spark, out, "t")
        table = spark.createDataFrame([(0, "seed")], "id int, v string") if have is None else have
        rows_ = spark.createDataFrame([(1, "new"), (run, "again")], "id int, v string")
        store_tables({"t": get_or_create(table, "id", rows_)}, out)
        failing = stored_table(spark, out, "t").withColumn("v", F.raise_error(F.lit("broken")).cast("string"))
        with pytest.raises(Exception, match="broken"):
            store_tables({"t": failing}, out)
    assert [r[0] for r in rows(stored_table(spark, out, "t"), "id")] == [0, 1, 2, 3]
    assert len([p for p in (tmp_path / "tables" / "t").iterdir() if p.is_dir()]) <= 3


def test_time_steps_plan(spark):
    steps = spark.createDataFrame([(1, 10, 0), (4, 0, 1)], "id int, length_minutes int, length_months int")
    df = spark.createDataFrame([(1, 10), (2, 1), (3, 1), (None, 10), (1, 1), (2, None)], "u int, l int")
    joined = match_time_steps(df, "u", "l", steps)
    assert "NestedLoop" not in final_plan(joined)
    assert rows(joined, "u", "l", "time_step_id") == [
        (None, 10, None), (1, 1, None), (1, 10, 1), (2, None, None), (2, 1, 4), (3, 1, None),
    ]


def test_append(spark):
    target = spark.createDataFrame([(1, "a", None)], "id bigint, t string, n int")
    added = append(target, spark.createDataFrame([(2, 3)], "id int, n int"))
    assert added.dtypes == target.dtypes and rows(added) == [(1, "a", None), (2, None, 3)]
    with pytest.raises(ValueError):
        append(target, spark.createDataFrame([(2,)], "other int"))


def test_copy_dump(spark, tmp_path):
    path = tmp_path / "dump.sql"
    path.write_text(
        "--\n-- areas\nCOPY area (id, size) FROM stdin;\n1\t\\N\n2\t2.5\n\\.\n\n\n"
        "COPY entity (id, name, remarks) FROM stdin;\n1\tΑττική  \t\n2\t\\N\ta\\tb\\\\N\\nc\n\\.\n"
        "COPY skipped (id) FROM stdin;\n9\n\\.\nCOPY area (id, size) FROM stdin;\n3\t1\n\\.\n",
        encoding="utf-8",
    )
    schemas = {"area": "id int, size double", "entity": "id int, name string, remarks string"}
    tables = read_copy_dump(spark, str(path), schemas)
    assert rows(tables["area"]) == [(1, None), (2, 2.5), (3, 1.0)]
    assert rows(tables["entity"]) == [(1, "Αττική  ", ""), (2, None, "a\tb\\N\nc")]
    (tmp_path / "dumps").mkdir()
    for i in range(3):
        (tmp_path / "dumps" / f"{i}.sql").write_text(f"COPY area (id, size) FROM stdin;\n{i}\t1\n\\.\n")
    assert rows(read_copy_dump(spark, str(tmp_path / "dumps"), schemas)["area"], "id") == [(0,), (1,), (2,)]
    # Many splits of one file: rows stay with their header.
    big = tmp_path / "big.sql"
    with open(big, "w") as out:
        for t in range(4):
            out.write(f"COPY t{t} (id, v) FROM stdin;\n" + "".join(f"{i}\tv{t}\n" for i in range(2000)) + "\\.\n")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        tables = read_copy_dump(spark, str(big), {f"t{t}": "id int, v string" for t in range(4)})
        for t in range(4):
            assert rows(tables[f"t{t}"].groupBy("v").agg(F.count("*"), F.sum("id"))) == [(f"v{t}", 2000, 1999000)]
        # The rows are the same when splits are packed otherwise between the call and the use.
        tables = read_copy_dump(spark, str(big), {f"t{t}": "id int, v string" for t in range(4)})
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000000")
        assert [tables[f"t{t}"].count() for t in range(4)] == [2000] * 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_copy_dump_without_end(spark, tmp_path):
    for name, text in (("middle", "COPY a (id) FROM stdin;\n1\nCOPY b (id) FROM stdin;\n2\n\\.\n"), ("last", "COPY a (id) FROM stdin;\n1\n\\.\nCOPY b (id) FROM stdin;\n2\n")):
        (tmp_path / name).write_text(text)
        with pytest.raises(ValueError, match="no end mark for table"):
            read_copy_dump(spark, str(tmp_path / name), {"a": "id int", "b": "id int"})
    (tmp_path / "none").write_text("COPY a (id) FROM stdin;\n\\.\n")
    assert read_copy_dump(spark, str(tmp_path / "none"), {"a": "id int"})["a"].count() == 0


def test_copy_text_errors(spark, tmp_path):
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part").write_text("1\t2\n1\n")
    with pytest.raises(Exception, match="expected 2 fields"):
        read_copy_text(spark, str(tmp_path / "bad"), "a int, b int").collect()


def test_copy_text_round_trip(spark, tmp_path):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    pieces = st.lists(st.sampled_from(["\\", "\\N", "\t", "\n", "\r", "n", "N", "", "ü", "\b", "\v", "\f", "."]), max_size=6)

    @settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.one_of(st.none(), pieces.map("".join)), min_size=1, max_size=40))
    def check(texts):
        path = str(tmp_path / f"copy{check.n}")
        check.n += 1
        df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
        write_copy_text(df, path)
        assert rows(read_copy_text(spark, path, "i int, t string")) == rows(df)

    check.n = 0
    check()


def test_small_helpers(spark):
    assert snapshot_names(["A", "CLOUD_OBSERVATION", "stations"]) == ["A", "stations"]
    assert unit_variables(spark, {4: (4, 9)}).count() == 2


def test_record_lines_round_trip(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    from stationflow.operators.series import number_lines, parsed_records

    moments = st.datetimes(dt.datetime(1900, 1, 1), dt.datetime(2100, 1, 1)).map(lambda t: t.replace(second=0, microsecond=0))
    values = st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False))
    flags = st.text(st.characters(blacklist_categories=["Cc", "Cs"], blacklist_characters="\x85\u2028\u2029"), max_size=8)

    @settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.tuples(st.integers(0, 99), moments, flags, values), min_size=1, max_size=60))
    def check(records):
        schema = "id int, datein timestamp_ntz, flag string, value double"
        df = spark.createDataFrame(records, schema).withColumn("additional", F.lit(None).cast("string"))
        parsed = parsed_records(number_lines(df).withColumn("line", F.concat("line", F.lit("\r"))))
        expected = df.select("id", F.col("datein").alias("ts"), "value", F.col("flag").alias("flags"))
        assert rows(parsed) == rows(expected)

    check()
