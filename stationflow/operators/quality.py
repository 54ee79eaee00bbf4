"""Checks that report rows instead of failing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.functions.records import is_month_start
from stationflow.operators.skew import one_per_key


def fk_violations(child: DataFrame, fk: str, parent: DataFrame, pk: str, unique: bool = True) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent; ``unique=False`` for a key that repeats."""
    keys = parent.select(F.col(pk).alias("_pk"))
    keys = keys if unique else one_per_key(keys, ["_pk"])
    return child.where(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_pk"), "left_anti")


def fk_report(checks: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """``(reference, violations)`` for named (child, fk, parent, pk) checks."""
    result = None
    for name, child, fk, parent, pk in checks:
        counted = fk_violations(child, fk, parent, pk).agg(F.count("*").alias("violations"))
        part = counted.select(F.lit(name).alias("reference"), "violations")
        result = part if result is None else result.unionAll(part)
    return result


def month_start_violations(records: DataFrame, moment: str = "ts") -> DataFrame:
    """Records not stamped with midnight of the first day of a month."""
    return records.where(~is_month_start(moment))
