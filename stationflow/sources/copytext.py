"""Tab-separated dumps: ``\\N`` is NULL, '' is the empty text, ``\\.`` ends a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType
from pyspark.sql.window import Window

from stationflow.session import work_dir, written

# The escapes of the dump format besides \\ and \N.
_ESCAPES = [("b", "\b"), ("f", "\f"), ("n", "\n"), ("r", "\r"), ("t", "\t"), ("v", "\v")]

_HEADER = r"^COPY +([^ (]+) *\((.*)\) +FROM +stdin;$"


def _unescaped(field: Column) -> Column:
    """Undo the escapes; the text is cut at escaped backslashes first, so each is read once."""
    def plain(piece: Column) -> Column:
        for letter, character in _ESCAPES:
            piece = F.replace(piece, F.lit("\\" + letter), F.lit(character))
        return piece

    pieces = F.transform(F.split(field, r"\\\\", -1), plain)
    return F.when(field.contains("\\"), F.array_join(pieces, "\\")).otherwise(field)


def _escaped(field: Column) -> Column:
    field = F.replace(field, F.lit("\\"), F.lit("\\\\"))
    for letter, character in _ESCAPES:
        field = F.replace(field, F.lit(character), F.lit("\\" + letter))
    return field


def parse_copy_lines(lines: DataFrame, schema: StructType, line: str = "value") -> DataFrame:
    """Dump lines as typed rows. A line with another number of fields is an error."""
    fields = F.split(F.col(line), "\t", -1)
    count = len(schema.fields)
    checked = F.when(F.size(fields) == count, fields).otherwise(
        F.raise_error(F.concat(F.lit(f"expected {count} fields: "), F.col(line)))
    )
    split = lines.select(checked.alias("_fields"))
    columns = []
    for i, field in enumerate(schema.fields):
        raw = F.col("_fields")[i]
        value = F.when(raw != r"\N", _unescaped(raw))
        if not isinstance(field.dataType, StringType):
            value = value.cast(field.dataType)
        columns.append(value.alias(field.name))
    return split.select(*columns)


def read_copy_text(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One table's rows from a file or folder of dump lines; the end mark is skipped."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    lines = spark.read.option("lineSep", "\n").text(path).where(F.col("value") != r"\.")
    return parse_copy_lines(lines, schema)


def read_copy_dump(spark: SparkSession, path: str, schemas: dict[str, StructType | str]) -> dict[str, DataFrame]:
    """Several tables from dump files with ``COPY table (columns) FROM stdin;`` headers.

    The lines are read once and written with their place: file, the begin of
    their split, and their number in it. A row belongs to the last header before
    it in its file: within a split that is the last one above it, and each split
    takes over the header that is open where it begins, from a table with a row
    per split. So neither the number of headers nor the length of a file meets a
    single task or the driver. Columns are taken by the headers' names. A table
    without its end mark is an error.
    """
    places = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    value = F.col("value")
    inside = F.regexp_extract(value, _HEADER, 1) != ""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    header = F.struct(F.regexp_extract(value, _HEADER, 1).alias("name"), F.regexp_extract(value, _HEADER, 2).alias("columns"))
    lines = written(lines.withColumns({"header": F.when(inside, header), "end": value == r"\."}), "dump-lines")
    # The mark that counts for a line: the last header or end before it.
    mark = F.when(F.col("header").isNotNull() | F.col("end"), F.struct("end", "header"))
    splits = lines.groupBy("file", "block").agg(
        F.max_by(mark, F.when(mark.isNotNull(), F.col("row"))).alias("last"),
    )
    ahead = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opened = splits.select(
        F.col("file").alias("_file"), F.col("block").alias("_block"), F.last("last", ignorenulls=True).over(ahead).alias("open"),
    )
    followed = lines.withColumn("mark", F.last(mark, ignorenulls=True).over(places))
    placed = followed.join(opened, (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")))
    current = F.coalesce("mark", "open")
    _check_ends(lines)
    rows = placed.where(F.col("header").isNull() & ~F.col("end")).withColumn("current", current)
    rows = rows.where(~F.col("current.end")).select("value", F.col("current.header.name").alias("name"), F.col("current.header.columns").alias("columns"))
    named = F.regexp_replace("name", '^"|"$', "")
    rows = rows.withColumn("name", named).where(F.col("name").isin(list(schemas)))
    folder = work_dir(spark, "dump-tables")
    rows.write.partitionBy("name").parquet(folder)
    tables: dict[str, DataFrame] = {}
    stored = spark.read.schema("value string, columns string, name string").parquet(folder)
    for found in sorted(stored.select("name", "columns").distinct().collect()):
        schema = schemas[found["name"]]
        schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        listed = StructType([schema[c.strip().strip('"')] for c in found["columns"].split(",")])
        own = stored.where((F.col("name") == found["name"]) & (F.col("columns") == found["columns"]))
        parsed = parse_copy_lines(own, listed)
        known = tables.get(found["name"])
        tables[found["name"]] = parsed if known is None else known.unionByName(parsed, allowMissingColumns=True)
    for name in {r["name"] for r in lines.where("header IS NOT NULL").select(F.regexp_replace("header.name", '^"|"$', "").alias("name")).distinct().collect()}:
        if name in schemas and name not in tables:  # a header without rows
            schema = schemas[name]
            tables[name] = spark.createDataFrame([], StructType.fromDDL(schema) if isinstance(schema, str) else schema)
    return tables


def _check_ends(lines: DataFrame) -> None:
    """Every header is followed by its end mark before the next header of its file.

    Marks are ordered inside their split; of each split only the first and the last one
    are ordered by file.
    """
    marks = lines.where(F.col("header").isNotNull() | F.col("end"))
    opened = F.when(F.col("header").isNotNull(), F.col("header.name"))
    inside = Window.partitionBy("file", "block").orderBy("row")
    followed = marks.select("file", "block", "row", opened.alias("name"), F.lead(opened).over(inside).alias("next"))
    splits = followed.groupBy("file", "block").agg(
        F.min_by(F.struct("name"), "row").alias("first"), F.max_by(F.struct("name"), "row").alias("last"),
        F.min(F.when(F.col("next").isNotNull(), F.col("name"))).alias("unended"),
    )
    after = F.lead("first").over(Window.partitionBy("file").orderBy("block"))
    across = F.when(after.isNull() | after["name"].isNotNull(), F.col("last.name"))
    found = splits.select("file", F.coalesce("unended", across).alias("name")).where("name IS NOT NULL").limit(1).collect()
    if found:
        raise ValueError(f"no end mark for table {found[0]['name']} in {found[0]['file']}")


def copy_lines(df: DataFrame) -> DataFrame:
    """Rows as dump lines in one ``value`` column."""
    fields = [F.coalesce(_escaped(F.col(c).cast("string")), F.lit(r"\N")) for c in df.columns]
    return df.select(F.concat_ws("\t", *fields).alias("value"))


def write_copy_text(df: DataFrame, path: str) -> None:
    """Write the rows as a folder of dump lines."""
    copy_lines(df).write.mode("overwrite").option("lineSep", "\n").text(path)
