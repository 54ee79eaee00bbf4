"""Time-series tables: ``(id, ts, value, flags)`` records and their metadata."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.functions import values
from stationflow.functions.decode import compass_degrees, decode
from stationflow.functions.records import (
    merged_flags,
    packed_clouds,
    phase_minutes,
    record_line,
    slashed,
)
from stationflow.functions.text import first_stamp, minute_stamp, number_text
from stationflow.operators.documents import PART_BYTES, ordered_parts
from stationflow.operators.joins import members
from stationflow.operators.skew import one_per_key
from stationflow.operators.tables import stack
from stationflow.operators.updates import new, update_from


def series_ids(kinds: Mapping[str, DataFrame]) -> DataFrame:
    """``(id, kind)``: the distinct ids of each kind of table, all lists in one, sorted."""
    lists = [t.select("id").distinct().withColumn("kind", F.lit(kind)) for kind, t in kinds.items()]
    return stack(*lists).orderBy("id", "kind")


def merged_kinds(numbers: DataFrame, texts: DataFrame) -> DataFrame:
    """Records of both kinds; of an id found in both, only the text records remain."""
    taken = one_per_key(texts.select(F.col("id").alias("_taken")), ["_taken"])
    kept = numbers.join(taken, F.col("id") == F.col("_taken"), "left_anti")
    return stack(kept, texts)


def number_lines(df: DataFrame) -> DataFrame:
    """``(id, ts, line)`` of records with numeric values."""
    line = record_line("datein", number_text("value"), merged_flags("flag", "additional"))
    return df.select("id", F.col("datein").alias("ts"), line.alias("line"))


def text_lines(df: DataFrame) -> DataFrame:
    """``(id, ts, line)`` of records with compass names as values."""
    line = record_line("datein", compass_degrees("value"), merged_flags("flag", "additional"))
    return df.select("id", F.col("datein").alias("ts"), line.alias("line"))


def cloud_lines(df: DataFrame) -> DataFrame:
    """``(id, ts, line)`` of cloud observations in four layers."""
    layers = [(f"cloud_type{i}", f"cloud_pct{i}", f"cloud_height{i}") for i in range(1, 5)]
    return df.select(
        "id", F.col("datein").alias("ts"), record_line("datein", F.lit(""), packed_clouds(layers)).alias("line")
    )


def weather_lines(df: DataFrame) -> DataFrame:
    """``(id, ts, line)`` of weather observations."""
    codes = slashed("current_weather", "past_weather1", "past_weather2")
    return df.select("id", F.col("datein").alias("ts"), record_line("datein", F.lit(""), codes).alias("line"))


def parsed_records(lines: DataFrame, line: str = "line") -> DataFrame:
    """``(id, ts, value, flags)`` from ``date,value,flags`` lines; an empty value is NULL."""
    fields = F.split(F.regexp_replace(line, "\r$", ""), ",", 3)
    return lines.select(
        "id",
        minute_stamp(fields[0]).alias("ts"),
        F.nullif(fields[1], F.lit("")).cast("double").alias("value"),
        fields[2].alias("flags"),
    )


def series_texts(lines: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """``(id, part, content)``: all lines of a series in time order, each ended by CR LF.

    A series longer than ``part_bytes`` continues in further parts.
    """
    return ordered_parts(lines, ["id"], ["ts"], F.concat(F.col("line"), F.lit("\r\n")), sep="", part_bytes=part_bytes)


def shifted_series(
    records: DataFrame, series: DataFrame, steps: Sequence[int] = (4, 5), hours: int = 1, keep_others: bool = False
) -> DataFrame:
    """Records of the series with these time steps, moved by some hours.

    ``keep_others`` also returns the other records, unmoved.
    """
    stepped = series.where(F.col("time_step_id").isin(*steps)).select(F.col("id").alias("_chosen"))
    chosen = one_per_key(stepped, ["_chosen"])
    moved = F.col("ts") + F.make_dt_interval(hours=F.lit(hours))
    same = F.col("id") == F.col("_chosen")
    if not keep_others:
        return records.join(chosen, same, "left_semi").withColumn("ts", moved)
    joined = records.join(chosen, same, "left")
    return joined.withColumn("ts", F.when(F.col("_chosen").isNotNull(), moved).otherwise(F.col("ts"))).drop("_chosen")


def phases(series: DataFrame, chunks: DataFrame, steps: Mapping[int, int] = values.PHASE_STEP_MINUTES) -> DataFrame:
    """``(id, phase)`` of the strict series: the first stamp's place within its step.

    Series without a chunk, or whose first line is empty, are left out.
    """
    strict = series.where(
        F.col("time_step_id").isin(*steps) & F.col("nominal_offset_minutes").isNotNull()
    ).select(F.col("id").alias("_series"), decode("time_step_id", steps).alias("_step"))
    stamps = (
        members(chunks.select("id", first_stamp("bottom").alias("_stamp")), "id", strict, "_series")
        .where(F.col("_stamp") != "")
        .groupBy("id")
        .agg(F.min("_stamp").alias("_stamp"))
    )
    moment = minute_stamp(F.col("_stamp"))
    return stamps.join(strict, F.col("id") == F.col("_series")).select(
        "id", phase_minutes(moment, F.col("_step")).alias("phase")
    )


def with_phases(series: DataFrame, chunks: DataFrame, steps: Mapping[int, int] = values.PHASE_STEP_MINUTES) -> DataFrame:
    """The series table with the nominal offset set to the phase."""
    return update_from(
        series, phases(series, chunks, steps), {"id": "id"}, {"nominal_offset_minutes": new("phase")}, unique=True
    )


def canonical(df: DataFrame, key: str, moment: str, value: Column, flags: Column) -> DataFrame:
    """Any table as ``(id, ts, value, flags)`` records."""
    return df.select(
        F.col(key).alias("id"), F.col(moment).cast("timestamp_ntz").alias("ts"),
        value.alias("value"), flags.alias("flags"),
    )
