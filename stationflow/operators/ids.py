"""New keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationflow.session import written

_ROW_BITS = 33


def next_id(table: DataFrame, key: str = "id", empty: int | None = 1) -> Column:
    """``max(key) + 1`` as a one-value subquery; ``empty`` is the result without rows."""
    top = F.max(key) + 1
    value = top if empty is None else F.coalesce(top, F.lit(empty))
    return table.agg(value.alias("next_id")).scalar()


def next_ids(tables: Mapping[str, DataFrame], key: str = "id", empty: int | None = 1) -> DataFrame:
    """``(table, next_id)`` for several tables."""
    parts = [
        table.agg(F.max(F.col(key).cast("long")).alias("_max")).select(
            F.lit(name).alias("table_name"),
            (F.col("_max") + 1 if empty is None else F.coalesce(F.col("_max") + 1, F.lit(empty))).alias("next_id"),
        )
        for name, table in tables.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionAll(part)
    return result


def assign_ids(
    df: DataFrame, order: Sequence[str], start: Column | int = 1, name: str = "id", unique: bool = False
) -> DataFrame:
    """Number the rows ``start, start+1, …`` in the given order, without gaps.

    Only keys are sorted: the order columns, two hashes of the others for ties, and the
    place of the row in its file, so that copies of one row spread over tasks too.
    ``unique`` says the order columns identify a row and saves the hashes. The sorted
    places are written, because ranges are drawn from a sample and must be the same
    wherever they are read; a row per range turns them into one sequence, and the rows
    take their numbers by file and place, in a merge join: a file's path is hardly counted
    in the sizes by which Spark would choose a broadcast, yet stands in each of its rows.
    Rows that come straight from files are left there; others are written once first.
    """
    rows = df if _of_files(df) else written(df, "unnumbered")
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    rest = [c for c in df.columns if c not in order]
    ties = [] if unique or not rest else [F.xxhash64(F.lit(seed), *rest).alias(f"_tie{seed}") for seed in (0, 1)]
    keys = rows.select(*[F.col(c).alias(f"_order_{i}") for i, c in enumerate(order)], *ties, *place)
    sort = [F.col(c).asc_nulls_last() for c in keys.columns]
    ranged = keys.repartitionByRange(*sort).sortWithinPartitions(*sort).select("_file", "_row")
    placed = written(ranged.withColumn("_place", F.monotonically_increasing_id()), "numbered")
    task = F.shiftright("_place", _ROW_BITS)
    row = F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1)
    sizes = placed.groupBy(task.alias("_task")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task of the sort.
    offsets = F.broadcast(sizes.select("_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")))
    first = F.lit(start) if isinstance(start, int) else start
    numbered = placed.withColumn("_task", task).join(offsets, "_task")
    numbers = numbered.select("_file", "_row", (first + F.col("_offset") + row).cast("long").alias(name))
    return rows.select(*df.columns, *place).join(numbers.hint("merge"), ["_file", "_row"]).select(*df.columns, name)


def _of_files(df: DataFrame) -> bool:
    """Whether each row is one row of a file, chosen and projected but not joined or multiplied."""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.child()
    return node.nodeName() == "LogicalRelation" and "HadoopFsRelation" in node.relation().getClass().getName()
