"""Tables of a source schema."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The tables whose records are exported apart from the snapshot.
RECORD_TABLES = (
    "raw_timeseries_float_data",
    "raw_timeseries_string_data",
    "pr_timeseries_float_data",
    "pr_timeseries_string_data",
    "cloud_observation",
    "cloud_observation1",
    "weather_observation",
)


def rows(spark: SparkSession, sql: str, tables: Mapping[str, DataFrame] | None = None, **arguments: object) -> DataFrame:
    """The rows of a query; ``:name`` marks an argument and ``{name}`` one of ``tables``."""
    return spark.sql(sql, args=arguments or None, **(tables or {}))


def snapshot_names(names: Iterable[str], exclude: Iterable[str] = RECORD_TABLES) -> list[str]:
    """Table names without the excluded ones, whatever their case."""
    left_out = {n.lower() for n in exclude}
    return [n for n in names if n.lower() not in left_out]


def snapshot(
    names: Iterable[str], open_table: Callable[[str], DataFrame], out: str, exclude: Iterable[str] = RECORD_TABLES
) -> dict[str, str]:
    """Write every table but the excluded ones as parquet below ``out``.

    ``open_table`` gives the DataFrame of a name, from a catalog, files or JDBC.
    """
    written = {}
    for name in snapshot_names(names, exclude):
        written[name] = f"{out.rstrip('/')}/{name}"
        open_table(name).write.mode("overwrite").parquet(written[name])
    return written


def read_blobs(df: DataFrame, key: str, blob: str) -> DataFrame:
    """Key and content of the rows that have a non-empty blob, in one scan."""
    return df.select(key, blob).where(F.octet_length(blob) > 0)
