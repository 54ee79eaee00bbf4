"""Table updates expressed as joins that return the whole new table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.operators.joins import not_in
from stationflow.operators.skew import one_per_key
from stationflow.operators.tables import append


def new(column: str) -> Column:
    """A column of the update's source row; plain column names are the target's."""
    return F.col(f"_new.{column}")


def update_from(
    target: DataFrame,
    source: DataFrame,
    on: Mapping[str, str],
    sets: Mapping[str, Column],
    order: Sequence[str] | None = None,
    unique: bool = False,
) -> DataFrame:
    """``UPDATE target SET … FROM source WHERE …`` as a new table.

    ``on`` maps target to source columns. A matched row takes the new value even
    when that is NULL; other rows stay as they are. Of several source rows with
    one key the lowest by ``order`` (by all columns if not given) is used, picked
    before the join so the target never multiplies. ``unique`` says the source
    has one row per key and saves that step.
    """
    unknown = set(sets) - set(target.columns)
    if unknown:
        raise ValueError(f"the table has no column {sorted(unknown)}")
    row = F.struct(*[F.col(c) for c in source.columns])
    sources = [F.col(s) for s in on.values()]
    key_names = [f"_key_{i}" for i in range(len(on))]
    usable = reduce(Column.__and__, [F.col(s).isNotNull() for s in on.values()])
    keyed = source.where(usable)
    if unique:
        picked = keyed.select(*[s.alias(k) for s, k in zip(sources, key_names)], row.alias("_new"))
    else:
        best = F.min_by(row, F.struct(*[F.col(c) for c in order])) if order else F.min(row)
        picked = one_per_key(keyed.withColumns(dict(zip(key_names, sources))), key_names, best.alias("_new"))
    same = [F.col(t) == F.col(k) for t, k in zip(on, key_names)]
    joined = target.join(picked, same, "left")
    matched = F.col("_new").isNotNull()
    columns = [
        F.when(matched, sets[c]).otherwise(F.col(c)).alias(c) if c in sets else F.col(c)
        for c in target.columns
    ]
    return joined.select(*columns)


def update_where_in(
    target: DataFrame, key: str, other: DataFrame, other_key: str, sets: Mapping[str, Column], unique: bool = False
) -> DataFrame:
    """Set columns on the rows whose key occurs in another table; ``unique`` says once at most."""
    present = other.select(F.col(other_key).alias("_member")).where(F.col("_member").isNotNull())
    keys = present if unique else one_per_key(present, ["_member"])
    joined = target.join(keys, F.col(key) == F.col("_member"), "left")
    found = F.col("_member").isNotNull()
    return joined.select(
        *[
            F.when(found, sets[c]).otherwise(F.col(c)).alias(c) if c in sets else F.col(c)
            for c in target.columns
        ]
    )


def missing_keys(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Keys of the child that the parent lacks (``NOT IN``), each as often as it occurs."""
    return not_in(child.select(F.col(child_key).alias("_k")), "_k", parent, parent_key).select(
        F.col("_k").alias(parent_key)
    )


def insert_missing(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, defaults: Mapping[str, Column] | None = None
) -> DataFrame:
    """The parent with a default row for every child key it lacks."""
    rows = missing_keys(child, child_key, parent, parent_key)
    return append(parent, rows.withColumns(dict(defaults or {})))


def get_or_create(table: DataFrame, key: str, rows: DataFrame) -> DataFrame:
    """The table with those rows whose key it does not have yet; of several, the lowest by all columns."""
    whole = F.struct(*[F.col(c) for c in rows.columns])
    wanted = rows.groupBy(F.col(key).alias("_wanted")).agg(F.min(whole).alias("_row")).select("_row.*")
    have = one_per_key(table.select(F.col(key).alias("_have")).where(F.col("_have").isNotNull()), ["_have"])
    return append(table, wanted.join(have, F.col(key) == F.col("_have"), "left_anti"))


def load_once(existing: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows if the existing table is empty, otherwise none.

    A one-value subquery instead of a driver-side check keeps the plan lazy.
    """
    count = existing.limit(1).agg(F.count("*").alias("n"))
    return rows.where(count.scalar() == 0)
