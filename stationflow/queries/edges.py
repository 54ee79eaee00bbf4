"""Inputs made awkward on purpose: empty names and blobs, missing lines, repeated runs, payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationflow.operators.documents import ordered_parts
from stationflow.operators.ids import assign_ids
from stationflow.operators.series import phases, series_texts
from stationflow.operators.updates import get_or_create
from stationflow.plans.common import Target
from stationflow.plans.national import add_people
from stationflow.queries import query, table
from stationflow.queries.series import event_lines
from stationflow.session import work_dir
from stationflow.sinks.files import write_blobs
from stationflow.sinks.tables import store_tables, stored_table
from stationflow.sources.copytext import copy_lines, read_copy_dump
from stationflow.sources.tables import read_blobs


@query("SELECT page_id, row_number() OVER (ORDER BY page_id) + 9 AS id, md5(html) AS digest FROM pages")
def numbered_pages(spark, folder):
    """The pages' texts are payload: they take no part in the sort."""
    pages = table(spark, folder, "pages")
    numbered = assign_ids(pages, ["page_id"], start=10)
    return numbered.select("page_id", "id", F.md5("html").alias("digest"))


@query("""
    SELECT doc_id AS id, md5(text) AS digest FROM documents WHERE lang NOT IN ('de', 'es') AND doc_id % 3 <> 0
""")
def filled_blobs(spark, folder):
    """Absent and empty contents and absent names give no file."""
    lang = F.col("lang")
    documents = table(spark, folder, "documents").withColumn(
        "content", F.when(lang == "es", "").when(lang != "de", F.col("text"))
    )
    path = work_dir(spark, "filled-blobs")
    name = F.when(F.col("doc_id") % 3 != 0, F.format_string("%d.txt", "doc_id"))
    write_blobs(read_blobs(documents, "doc_id", "content"), path, name, "content")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
    stem = F.split_part(F.col("_metadata.file_name"), F.lit("."), F.lit(1))
    return files.select(stem.cast("long").alias("id"), F.md5("content").alias("digest"))


_OBSERVERS_SQL = """
    SELECT c_custkey AS stationid,
           CASE c_nationkey % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE c_mktsegment || ' N' || c_nationkey END AS observer
    FROM customer
"""


@query(f"""
    WITH named AS (SELECT observer, min(stationid) AS first FROM ({_OBSERVERS_SQL}) WHERE observer <> '' GROUP BY observer),
    people AS (SELECT observer, row_number() OVER (ORDER BY first) + 7 AS person FROM named)
    SELECT split_part(observer, ' ', 1) AS last_name, split_part(observer, ' ', 2) AS first_name, person AS person_id,
           count(*) AS stations
    FROM people JOIN ({_OBSERVERS_SQL}) USING (observer) GROUP BY ALL
""")
def observers(spark, folder):
    """Empty and absent names give no person; one person for each name, who oversees its stations."""
    group = F.col("c_nationkey") % 4
    named = F.concat("c_mktsegment", F.lit(" N"), "c_nationkey")
    stations = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("stationid"), F.when(group == 0, "").when(group != 1, named).alias("observer")
    )
    target = Target({"lentity": spark.createDataFrame([(7, "", "")], "id int, remarks string, remarks_alt string")})
    add_people(stations, target)
    people = target["person"].select("lentity_ptr_id", "last_name", "first_name")
    joined = target["overseer"].join(people, F.col("person_id") == F.col("lentity_ptr_id"))
    return joined.groupBy("last_name", "first_name", "person_id").agg(F.count("*").alias("stations"))


@query("""
    WITH f AS (SELECT user_id AS id, min(ts) AS t FROM events WHERE user_id % 4 > 0 GROUP BY user_id)
    SELECT id, CAST(minute(t) % 10 AS INTEGER) AS phase FROM f
""")
def phase_empty_lines(spark, folder):
    """A series whose first line is empty has no phase."""
    chunks = series_texts(event_lines(spark, folder))
    bottom = F.when(F.col("id") % 4 == 0, F.concat(F.lit("\n"), "content")).otherwise(F.col("content"))
    series = table(spark, folder, "events").select(
        F.col("user_id").alias("id"), F.lit(1).alias("time_step_id"), F.lit(0).alias("nominal_offset_minutes")
    ).distinct()
    return phases(series, chunks.select("id", bottom.alias("bottom")))


@query("""
    SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_custkey % 2 = 0
    UNION ALL SELECT c_custkey, 'new ' || c_name FROM customer WHERE c_custkey % 2 = 1
""")
def stored_twice(spark, folder):
    """A table loaded twice onto one place has each row once."""
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    rows = customers.withColumn("name", F.concat(F.lit("new "), "name"))
    place = work_dir(spark, "stored-twice")
    store_tables({"people": customers.where("id % 2 = 0")}, place)
    for _ in range(2):
        store_tables({"people": get_or_create(stored_table(spark, place, "people"), "id", rows)}, place)
    return stored_table(spark, place, "people")


@query("""
    SELECT 'documents' AS name, doc_id AS id, md5(text) AS digest FROM documents
    UNION ALL SELECT 'labels', doc_id, CASE WHEN toxic = 1 THEN NULL ELSE CAST(quality AS VARCHAR) END FROM labels
""")
def dump_of_two(spark, folder):
    """Two tables in one folder of dump files, each in several blocks."""
    labels = table(spark, folder, "labels")
    tables = {
        "documents": table(spark, folder, "documents").select("doc_id", "text"),
        "labels": labels.select("doc_id", F.when(F.col("toxic") != 1, F.col("quality")).alias("quality")),
    }
    path = work_dir(spark, "dump")
    for name, rows in tables.items():
        lines = copy_lines(rows).withColumn("name", F.lit(name))
        blocks = ordered_parts(lines, ["name"], ["value"], F.col("value"), part_bytes=1 << 18)
        header = f"COPY {name} ({', '.join(rows.columns)}) FROM stdin;\n"
        blocks.select(F.concat(F.lit(header), "content", F.lit("\n\\."))).write.mode("append").option("lineSep", "\n").text(path)
    read = read_copy_dump(spark, path, {"documents": "doc_id bigint, text string", "labels": "doc_id bigint, quality int"})
    return read["documents"].select(
        F.lit("documents").alias("name"), F.col("doc_id").alias("id"), F.md5("text").alias("digest")
    ).unionAll(read["labels"].select(F.lit("labels"), "doc_id", F.col("quality").cast("string")))
