"""Ordered text documents built from child rows."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType
from pyspark.sql.window import Window

from stationflow.functions import values
from stationflow.functions.text import minute_text, point_line, true_false
from stationflow.operators.joins import matching_parents
from stationflow.operators.skew import one_per_key
from stationflow.operators.tables import stack
from stationflow.operators.updates import new, update_from
from stationflow.session import written

# Bytes after which a document continues in its next part.
PART_BYTES = 64 << 20
# Bytes of the pieces that a part is put together from, and characters of a text in a sampled bound.
PIECE_OF_PART, _BOUND = 1 << 20, 64


def _joined(line: str, order: Sequence[str], sep: str) -> Column:
    """The lines of a group in order (NULLs last), ``sep`` between; absent lines are left out."""
    escaped = sep.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n").replace("\r", "\\r")
    sort = ", ".join(f"`{c}` ASC NULLS LAST" for c in order)
    text = F.expr(f"listagg(`{line}`, '{escaped}') WITHIN GROUP (ORDER BY {sort})")
    return F.coalesce(text, F.lit(""))


def ordered_parts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], line: Column, name: str = "content", sep: str = "\n",
    part_bytes: int = PART_BYTES, unique: bool = False,
) -> DataFrame:
    """Each key's sorted lines as consecutive texts ``(keys, part, content)``.

    A line belongs to the part that its first byte falls into, counted from the
    key's first line in units of ``part_bytes``; so parts have bounded size and
    depend on the rows alone. Reading the parts in order, with ``sep`` between
    them, gives the document. Keys without lines have no part. Equal order values
    follow the line's text.

    The lines of all keys are sorted into ranges over all tasks, so a key with a
    third of all rows is spread like any other. A task writes its lines as pieces
    with the bytes of the same key before them in that task; a row for each key
    and task then gives the bytes in the tasks before, and pieces meet in their
    parts. Equal lines are counted first and multiplied as pieces; ``unique`` says
    that there are none and saves that. Sampled bounds hold the beginning of a
    text only.
    """
    names = {f"_order_{i}": F.col(c) for i, c in enumerate(order)}
    rows = df.select(
        *keys, *[c.alias(n) for n, c in names.items()], F.concat(line, F.lit(sep)).alias("_line")
    ).where(F.col("_line").isNotNull())
    if unique:
        rows = rows.withColumn("_times", F.lit(1).cast("long"))
    else:
        rows = rows.groupBy(*rows.columns).agg(F.count("*").alias("_times"))
    bounds = [F.col(k) for k in keys]
    for column in [*names, "_line"]:
        text = isinstance(rows.schema[column].dataType, StringType)
        bounds.append((F.left(column, F.lit(_BOUND)) if text else F.col(column)).asc_nulls_last())
        if text:  # what follows a shortened text says nothing about the order
            break
    sort = [*keys, *[F.col(n).asc_nulls_last() for n in names], "_line"]
    sorted_ = rows.repartitionByRange(*bounds).sortWithinPartitions(*sort).select(*keys, "_times", "_line")
    schema = StructType([rows.schema[k] for k in keys]).add("_at", "long").add("_times", "long").add("_starts", ArrayType(IntegerType())).add("_text", "binary")
    size = max(1, min(part_bytes, PIECE_OF_PART))
    pieces = written(sorted_.mapInArrow(_pieces(len(keys), size), schema).withColumn("_task", F.spark_partition_id()), "pieces")
    length = F.octet_length("_text")
    sizes = pieces.groupBy("_task", *keys).agg(F.sum(length * F.col("_times")).alias("_size"))
    # A row for each key and task. Only the first key of a task has lines in those before: a row a task is left.
    ahead = Window.partitionBy(*keys).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.withColumn("_begin", F.sum("_size").over(ahead)).where(F.col("_begin") > 0).select(
        F.col("_task").alias("_same"), *[F.col(k).alias(f"_same_{i}") for i, k in enumerate(keys)], "_begin"
    )
    same = F.col("_task") == F.col("_same")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_same_{i}"))
    placed = pieces.join(F.broadcast(begins), same, "left").withColumn("_time", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_times") - 1)))
    placed = placed.withColumn("_from", F.coalesce("_begin", F.lit(0)) + F.col("_at") + F.col("_time") * length)
    part = lambda at: F.call_function("div", at, F.lit(part_bytes))
    placed = placed.withColumn("_part", F.explode(F.sequence(part(F.col("_from")), part(F.col("_from") + F.element_at("_starts", -1)))))
    # Where a piece's lines of a part and of the next one begin; a line longer than a part leaves the next ones empty.
    upto = lambda q: F.coalesce(F.array_min(F.filter("_starts", lambda s: F.col("_from") + s >= q * F.lit(part_bytes))), length)
    whole = (part(F.col("_from")) == F.col("_part")) & (part(F.col("_from") + F.element_at("_starts", -1)) == F.col("_part"))
    placed = placed.withColumn("_cut", F.when(whole, F.lit(0)).otherwise(upto(F.col("_part")))).withColumn("_next", F.when(whole, length).otherwise(upto(F.col("_part") + 1)))
    placed = placed.where(whole | (F.col("_cut") < F.col("_next")))
    cut = placed.select(
        *keys, (F.col("_part") + 1).alias("part"), "_from",
        F.when(whole, F.col("_text")).otherwise(F.substring("_text", F.col("_cut") + 1, F.col("_next") - F.col("_cut"))).alias("_text"),
    )
    text = F.expr("listagg(`_text`, X'') WITHIN GROUP (ORDER BY `_from`)")
    parts = cut.groupBy(*keys, "part").agg(text.alias("_text"))
    ended = F.substring("_text", F.lit(1), F.octet_length("_text") - len(sep.encode()))
    return parts.select(*keys, "part", ended.cast("string").alias(name))


def _pieces(keys: int, size: int):
    """Sorted ``(keys, times, line)`` batches as runs of lines with their key's bytes before them in this task.

    A run ends with the key, the batch, ``size`` bytes, or a line that occurs more than
    once; such a line is a run of its own, multiplied up to ``size``. Runs are slices
    of the batch's buffer, so their text is not copied.
    """
    def differs(column: pa.Array, other: pa.Array) -> np.ndarray:
        return pc.or_(pc.fill_null(pc.not_equal(column, other), False), pc.not_equal(column.is_null(), other.is_null())).to_numpy(zero_copy_only=False)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried = None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            columns = batch.columns[:keys]
            first = np.zeros(n, bool)  # whether a line is the first of its key
            first[0] = last is None or any(differs(c[:1], o)[0] for c, o in zip(columns, last, strict=True))
            for c in columns:
                first[1:] |= differs(c[1:], c[:-1])
            times, lines = batch["_times"].to_numpy(), batch["_line"]
            wide = pa.types.is_large_string(lines.type)
            _, offsets, data = lines.buffers()
            offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[lines.offset : lines.offset + n + 1].astype(np.int64)
            length = np.diff(offsets)
            total = np.concatenate([[0], np.cumsum(length * times)])
            heads = np.flatnonzero(first)
            at = total[:-1] - np.concatenate([[-carried], total[heads]])[np.cumsum(first)]
            cut = first | (np.diff(at // size, prepend=0) != 0) | (times > 1)
            cut[1:] |= times[:-1] > 1
            cut[0] = True
            begin = np.flatnonzero(cut)
            end = np.append(begin[1:], n)
            once = times[begin] == 1
            runs = [pa.array(begin), pa.array(at[begin]), pa.array(np.ones(len(begin), np.int64))]
            starts = pa.ListArray.from_arrays(pa.array(np.append(begin, n).astype(np.int32)), pa.array((at - np.repeat(at[begin], end - begin)).astype(np.int32)))
            bounds = pa.py_buffer(offsets[np.append(begin, n)].astype(np.int32))
            texts = pa.Array.from_buffers(pa.binary(), len(begin), [None, bounds, data or pa.py_buffer(b"")])
            kept = pa.array(once)
            yield made(columns, [*(x.filter(kept) for x in runs), starts.filter(kept), texts.filter(kept)])
            for row in begin[~once]:
                text, left, here = lines[row].as_py().encode(), int(times[row]), int(at[row])
                most = max(1, min(left, size // len(text))) if text else left
                for count, repeats in ((most, left // most), (left % most, 1)):
                    if count:
                        of = [pa.array([int(row)]), pa.array([here]), pa.array([repeats if text else 1])]
                        yield made(columns, [*of, pa.array([[i * len(text) for i in range(count if text else 1)]], pa.list_(pa.int32())), pa.array([text * count], pa.binary())])
                        here += count * len(text) * repeats
            last, carried = [c[-1:] for c in columns], int(at[-1] + length[-1] * times[-1])

    def made(columns: list[pa.Array], run: list[pa.Array]) -> pa.RecordBatch:
        rows, at, times, starts, texts = run
        names = [*(f"_key_{i}" for i in range(keys)), "_at", "_times", "_starts", "_text"]
        return pa.RecordBatch.from_arrays([*(c.take(rows) for c in columns), at, times, starts, texts], names=names)

    return task


def ordered_text(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    line: Column,
    name: str = "content",
    sep: str = "\n",
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One text per key: its lines in order, ``sep`` between, none after the last.

    One shuffle; a text is one value, so it is built in one task, and one beyond
    what a value can hold (2 GiB) is an error: ``ordered_parts`` has no such
    limit. Equal order values follow the line's text. ``extra`` adds aggregates
    over the same groups.
    """
    extra = dict(extra or {})
    names = {f"_order_{i}": F.col(c) for i, c in enumerate(order)}
    if extra:
        base = df.withColumns({**names, "_line": line})
    else:
        base = df.select(*keys, *[c.alias(n) for n, c in names.items()], line.alias("_line"))
    text = _joined("_line", [*names, "_line"], sep).alias(name)
    return base.groupBy(*keys).agg(text, *[c.alias(n) for n, c in extra.items()])


def curve_documents(curves: DataFrame, points: DataFrame, order: str, numbers: Sequence[str]) -> DataFrame:
    """``(id, content)`` for every curve: its points in order; '' without points."""
    texts = ordered_text(points, ["id"], [order], point_line(*numbers)).select(
        F.col("id").alias("_curve"), F.col("content").alias("_text")
    )
    return (
        curves.select("id")
        .join(texts, F.col("id") == F.col("_curve"), "left")
        .select("id", F.coalesce("_text", F.lit("")).alias("content"))
    )


def stage_discharge_documents(curves: DataFrame, segments: DataFrame, points: DataFrame) -> DataFrame:
    """``(id, content)`` for every curve: a header, then each dated segment with its points.

    ``Count`` counts the segments that have points, also those left out because
    a date is missing.
    """
    listed = ordered_text(
        points, ["id", "curve_num"], ["h"],
        F.concat(point_line("h", "q"), F.lit("\n")), name="_points", sep="",
        extra={"_n": F.count("*")},
    ).withColumnsRenamed({"id": "_id"})
    joined = segments.join(
        listed, (F.col("id") == F.col("_id")) & (F.col("num") == F.col("curve_num")), "left"
    )
    block = F.concat(segment_head(F.coalesce("_n", F.lit(0))), F.coalesce("_points", F.lit("")), F.lit("\n"))
    dated = F.col("start_date").isNotNull() & F.col("end_date").isNotNull()
    bodies = ordered_text(
        joined, ["id"], ["num"], F.when(dated, block), name="_body", sep="",
        extra={"_count": F.count("_n")},
    ).withColumnRenamed("id", "_curve")
    return (
        curves.select("id")
        .join(bodies, F.col("id") == F.col("_curve"), "left")
        .select(
            "id",
            F.concat(
                F.lit(values.CURVE_HEADER + "Count="),
                F.coalesce("_count", F.lit(0)).cast("string"),
                F.lit("\n\n"),
                F.coalesce("_body", F.lit("")),
            ).alias("content"),
        )
    )


def stage_discharge_parts(curves: DataFrame, segments: DataFrame, points: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """``(id, part, content)``: the documents of ``stage_discharge_documents`` in parts.

    Nothing is built as one value: headers, points and ends of segments are lines of
    their own, in order. A segment is known by ``id`` and ``num``.
    """
    counts = one_per_key(points.select(F.col("id").alias("_id"), F.col("curve_num").alias("_num")), ["_id", "_num"], F.count("*").alias("_n"))
    counted = segments.join(counts, (F.col("id") == F.col("_id")) & (F.col("num") == F.col("_num")), "left")
    having = one_per_key(counted.where(F.col("_n").isNotNull()).select(F.col("id").alias("_curve")), ["_curve"], F.count("*").alias("_count"))
    heads = curves.join(having, F.col("id") == F.col("_curve"), "left")
    count = F.coalesce("_count", F.lit(0)).cast("string")
    dated = counted.where(F.col("start_date").isNotNull() & F.col("end_date").isNotNull())
    listed = dated.select(F.col("id").alias("_curve"), F.col("num").alias("_segment"))
    drawn = points.join(listed, (F.col("id") == F.col("_curve")) & (F.col("curve_num") == F.col("_segment")), "left_semi")
    number, level = points.schema["h"].dataType.simpleString(), segments.schema["num"].dataType.simpleString()

    def lines(rows: DataFrame, kind: int, num: Column, h: Column, text: Column) -> DataFrame:
        return rows.select("id", F.lit(min(kind, 1)).alias("_head"), num.cast(level).alias("_level"), F.lit(kind).alias("_kind"), h.cast(number).alias("_h"), text.alias("_said"))

    none = F.lit(None)
    every = stack(
        lines(heads, 0, none, none, F.concat(F.lit(values.CURVE_HEADER + "Count="), count, F.lit("\n\n"))),
        lines(dated, 1, F.col("num"), none, segment_head(F.coalesce("_n", F.lit(0)))),
        lines(drawn, 2, F.col("curve_num"), F.col("h"), F.concat(point_line("h", "q"), F.lit("\n"))),
        lines(dated, 3, F.col("num"), none, F.lit("\n")),
    )
    return ordered_parts(every, ["id"], ["_head", "_level", "_kind", "_h"], F.col("_said"), sep="", part_bytes=part_bytes)


def segment_head(count: Column) -> Column:
    """What precedes a dated segment's points."""
    return F.concat(
        F.lit("StartDate="), minute_text("start_date"),
        F.lit("\nEndDate="), minute_text("end_date"),
        F.lit("\nStartMonth=1\nEndMonth=12\nExtension="), true_false("ext"),
        F.lit("\nLogarithmic="), true_false("log"),
        F.lit("\nOffset="), point_line("coffset"),
        F.lit("\nPointsCount="), count.cast("string"), F.lit("\n\n"),
    )


def write_documents(target: DataFrame, documents: DataFrame, key: str = "id", column: str = "content") -> DataFrame:
    """The target table with its text column replaced where there is a document."""
    return update_from(target, documents, {key: key}, {column: new(column)}, unique=True)


def segments_with_points(curves: DataFrame, segments: DataFrame, points: DataFrame) -> DataFrame:
    """``(id, count)``: per curve the segments that have at least one point."""
    counted = matching_parents(segments, ["id", "num"], points, ["id", "curve_num"], ["id"]).withColumnRenamed(
        "id", "_curve"
    )
    return (
        curves.select("id")
        .join(counted, F.col("id") == F.col("_curve"), "left")
        .select("id", F.coalesce("count", F.lit(0)).alias("count"))
    )
