"""Result tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from stationflow.sinks.store import BUCKET_ROWS, Store

_RECORDS = "records"


def write_series(records: DataFrame, path: str, bucket_rows: int = BUCKET_ROWS) -> None:
    """Replace the stored records of the series that occur in ``records``, all at once.

    The store is a table kept by ``id`` (see ``sinks.store``): its buckets grow in number
    with the records, and only those of the replaced series are read and written again.
    The records may come from the store itself. A long series spans several tasks and
    files. A record without id is an error. ``bucket_rows`` counts for a new store.
    """
    with Store(records.sparkSession, path).begin() as load:
        load.replace(_RECORDS, "id", records, bucket_rows)
        load.commit()


def read_series(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored records; None if there is no store."""
    return Store(spark, path).table(_RECORDS)


def store_tables(tables: Mapping[str, DataFrame], out: str, prefix: str = "", keep: int = 2) -> None:
    """Store a plan's tables below ``out`` under their prefixed names, all at once.

    A plan's tables hold the rows there were and the new ones, so each replaces the one
    before; it may be computed from that one. A failed run leaves everything in place.
    ``keep`` states stay. For checks, a dry run and ids see ``Store.begin``.
    """
    if not tables:
        return
    with Store(next(iter(tables.values())).sparkSession, out).begin() as load:
        for name, rows in tables.items():
            load.put(f"{prefix}{name}", rows)
        load.commit(keep=keep)


def stored_table(spark: SparkSession, out: str, name: str, prefix: str = "") -> DataFrame | None:
    """The current state of a stored table; None if there is none."""
    return Store(spark, out).table(f"{prefix}{name}")


def write_tables(tables: Mapping[str, DataFrame], out: str, prefix: str = "", mode: str = "append") -> dict[str, str]:
    """Write rows as parquet below ``out``, each table under its prefixed name.

    The default adds to what is there, which suits new rows alone; for whole
    tables of a plan use ``store_tables``.
    """
    written = {}
    for name, table in tables.items():
        written[name] = f"{out.rstrip('/')}/{prefix}{name}"
        table.write.mode(mode).parquet(written[name])
    return written
