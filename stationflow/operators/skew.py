"""Sides of joins that leave frequent keys to adaptive execution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """One row per key, for use as one side of a join.

    The rows are grouped by a struct of the keys. That gives the same groups, but
    rows that are partitioned by the keys already are not by the struct, nor is the
    result by the keys: the grouping has its own shuffle, after combining in the
    tasks, and so has the join. Only then can adaptive execution split a key that
    is frequent on the other side, wherever the rows come from.
    """
    grouped = df.groupBy(F.struct(*keys).alias("_keys")).agg(*aggregates or [F.lit(1).alias("_one")])
    return grouped.select(*[F.col("_keys").getField(k).alias(k) for k in keys], *[c for c in grouped.columns if c not in ("_keys", "_one")])
