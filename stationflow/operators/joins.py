"""Joins. No side is broadcast by hint: Spark picks the strategy from measured sizes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.functions.text import word
from stationflow.operators.skew import one_per_key


def members(df: DataFrame, column: str | Column, other: DataFrame, key: str, unique: bool = False) -> DataFrame:
    """Rows whose column occurs among the other table's keys (``IN``); ``unique`` says each occurs once."""
    column = F.col(column) if isinstance(column, str) else column
    present = other.select(F.col(key).alias("_member")).where(F.col("_member").isNotNull())
    keys = present if unique else one_per_key(present, ["_member"])
    return df.join(keys, column == F.col("_member"), "left_semi")


def not_in(df: DataFrame, column: str, other: DataFrame, key: str, unique: bool = False) -> DataFrame:
    """Rows whose column is ``NOT IN`` the other table's keys, NULLs included; ``unique`` says each occurs once.

    A NULL among the keys leaves no row; a NULL column leaves its row only when
    there are no keys at all. Spark plans a literal ``NOT IN`` as a broadcast of
    the whole key list whatever its size, so this is an ordinary anti join on
    distinct keys plus a one-row subquery on the same keys.
    """
    keys = other.select(F.col(key).alias("_key"))
    distinct = keys if unique else one_per_key(keys, ["_key"])
    facts = distinct.agg(
        F.coalesce(F.bool_or(F.col("_key").isNull()), F.lit(False)).alias("has_null"),
        (F.count("*") == 0).alias("empty"),
    )
    left = df.join(distinct, F.col(column) == F.col("_key"), "left_anti")
    about = facts.select(F.struct("has_null", "empty").alias("about")).scalar()
    return left.where(about["empty"] | (F.col(column).isNotNull() & ~about["has_null"]))


def left_with_fixed(
    df: DataFrame, column: str, other: DataFrame, key: str, value: str, fixed: Mapping[str, object], name: str
) -> DataFrame:
    """Left join to the rows of ``other`` that have the fixed values, taking one column."""
    for c, v in fixed.items():
        other = other.where(F.col(c) == v)
    picked = other.select(F.col(key).alias("_key"), F.col(value).alias(name))
    return df.join(picked, F.col(column) == F.col("_key"), "left").drop("_key")


def left_to_bridge(df: DataFrame, column: str, bridge: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Left join to a many-to-many bridge; a key with several values gives several rows."""
    pairs = bridge.select(F.col(key).alias("_key"), F.col(value).alias(name))
    return df.join(pairs, F.col(column) == F.col("_key"), "left").drop("_key")


def match_time_steps(df: DataFrame, unit: str, length: str, steps: DataFrame) -> DataFrame:
    """Left join a (unit, length) pair to the step catalogue.

    Unit 1 counts minutes, unit 2 months. Rewriting the either-or condition as
    two computed keys makes it an ordinary equi-join.
    """
    minutes = F.when(F.col(unit) == 1, F.col(length)).when(F.col(unit) == 2, F.lit(0))
    months = F.when(F.col(unit) == 1, F.lit(0)).when(F.col(unit) == 2, F.col(length))
    catalogue = steps.select(
        F.col("id").alias("time_step_id"), F.col("length_minutes"), F.col("length_months")
    )
    matched = (minutes == F.col("length_minutes")) & (months == F.col("length_months"))
    return df.join(catalogue, matched, "left")


def match_names(
    df: DataFrame, full_name: str, people: DataFrame, last: str, first: str, one_per_name: bool = False, key: str = "id"
) -> DataFrame:
    """Join a full name's first two words to people's last and first names.

    Several people of one name all match; ``one_per_name`` keeps the lowest key,
    which bounds the result by the size of ``df``.
    """
    if one_per_name:
        people = one_per_key(people, [last, first], F.min(key).alias(key))
    named = people.select(F.col(last).alias("_last"), F.col(first).alias("_first"), F.col(key).alias("person_id"))
    matched = (word(full_name, 1) == F.col("_last")) & (word(full_name, 2) == F.col("_first"))
    return df.join(named, matched, "inner").drop("_last", "_first")


def link_assets(assets: DataFrame, entities: DataFrame, pointer: str, link: str, kind: int | None = None) -> DataFrame:
    """``(entity_id, asset_id, source_id)``: asset row -> registry row -> source key.

    Replaces a membership test that refers to another table of the same query,
    which Spark would run as a nested loop.
    """
    if kind is not None:
        entities = entities.where(F.col("gtype_id") == kind)
    registry = entities.select(F.col("id").alias("asset_id"), F.col(link).alias("source_id"))
    return assets.select(
        F.col(pointer).alias("entity_id"), F.col("gisentity_ptr_id").alias("asset_id")
    ).join(registry, "asset_id")


def matching_parents(
    parents: DataFrame, parent_key: Sequence[str], children: DataFrame, child_key: Sequence[str],
    group: Sequence[str], name: str = "count",
) -> DataFrame:
    """Per group: how many parent rows have at least one child; 0 where none has."""
    names = [f"_{p}" for p in parent_key]
    present = one_per_key(children.select(*[F.col(c).alias(n) for c, n in zip(child_key, names)]), names)
    same = [F.col(p) == F.col(f"_{p}") for p in parent_key]
    joined = parents.join(present, same, "left")
    return joined.groupBy(*group).agg(F.count(f"_{parent_key[0]}").alias(name))


def carry_records(
    chunks: DataFrame, series: DataFrame, old_id: str | None = None, first_chunk_only: bool = False
) -> DataFrame:
    """Stored record chunks of the loaded series, ``top`` never NULL.

    With ``old_id`` the chunks' ids are source ids and become the series' new
    ids; without it, ids are kept and chunks of unknown series left out. The chunks,
    many for each series, aren't sorted for the join: a task holds its share of the
    series, two numbers each, and the chunks pass by.
    """
    if first_chunk_only:
        chunks = chunks.where(F.col("num") == 0)
    content = [F.coalesce("top", F.lit("")).alias("top"), F.col("middle"), F.col("bottom")]
    if old_id is None:
        return members(chunks, "id", series, "id").select("id", *content)
    loaded = series.where(F.col(old_id).isNotNull()).select(
        F.col("id").alias("_new_id"), F.col(old_id).alias("_old_id")
    )
    return chunks.join(loaded.hint("shuffle_hash"), F.col("id") == F.col("_old_id")).select(F.col("_new_id").alias("id"), *content)
