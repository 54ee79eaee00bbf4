"""Projections, routing and concatenation of whole tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stationflow.functions.keys import or_default
from stationflow.session import work_dir


def project(df: DataFrame, mapping: Mapping[str, Column | str | int | bool | None]) -> DataFrame:
    """One output column per entry: a Column, a source column's name, or a constant.

    Text is a column name; use ``F.lit`` for constant text.
    """
    return df.select(*[_expression(v).alias(name) for name, v in mapping.items()])


def _expression(value: Column | str | int | bool | None) -> Column:
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(value)


Specs = Mapping[str, Mapping[str, Column | str | int | bool | None]]


def tagged_rows(df: DataFrame, specs: Specs) -> DataFrame:
    """``(table_name, columns of all tables)``: a row for each source row and table, in one pass over the source.

    A column that a table lacks is NULL; tables that share a column must agree on its type.
    """
    return _tagged(df, {t: project(df, mapping) for t, mapping in specs.items()}, specs, lambda column, type_: column)


def split_entity(df: DataFrame, specs: Specs) -> dict[str, DataFrame]:
    """One source row as rows of several tables that share its key, in one pass over the source.

    The rows are written by table, so the source is read once however many tables there
    are, and each table reads its own files and columns.
    """
    tables = {t: project(df, mapping) for t, mapping in specs.items()}
    if len(tables) < 2:
        return tables

    def stored(column: str, type_: str) -> str:  # tables may differ in a column's type
        return f"{column} {type_}".translate(str.maketrans(" ,;{}()<>", "_________"))

    folder, rows = work_dir(df.sparkSession, "split"), _tagged(df, tables, specs, stored)
    rows.write.partitionBy("table_name").parquet(folder)
    every = df.sparkSession.read.schema(rows.schema).parquet(folder)
    return {
        t: every.where(F.col("table_name") == t).select(*[F.col(f"`{stored(c, type_)}`").alias(c) for c, type_ in table.dtypes])
        for t, table in tables.items()
    }


def _tagged(df: DataFrame, tables: Mapping[str, DataFrame], specs: Specs, stored: Callable[[str, str], str]) -> DataFrame:
    types = {stored(c, type_): type_ for table in tables.values() for c, type_ in table.dtypes}
    rows = []
    for t, table in tables.items():
        own = {stored(c, type_): (_expression(specs[t][c]), type_) for c, type_ in table.dtypes}
        wrong = [c for c, (_, type_) in own.items() if types[c] != type_]
        if wrong:
            raise ValueError(f"tables differ in the type of {wrong}")
        columns = [(own[c][0] if c in own else F.lit(None)).cast(type_).alias(c) for c, type_ in types.items()]
        rows.append(F.struct(F.lit(t).alias("table_name"), *columns))
    return df.select(F.explode(F.array(*rows)).alias("_row")).select("_row.*")


def default_nulls(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: or_default(c, v) for c, v in defaults.items()})


def copy_lookup(df: DataFrame, **extra: Column | str) -> DataFrame:
    """``(id, descr, descr_alt)`` with absent text as ''."""
    return project(
        df,
        {
            "id": "id",
            "descr": or_default("descr", ""),
            "descr_alt": or_default("descr_en", ""),
            **extra,
        },
    )


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """A small lookup table from fixed rows."""
    return spark.createDataFrame(list(rows), schema)


def unpivot_codes(df: DataFrame, key: str | Column, codes: Mapping[int, str]) -> DataFrame:
    """Nullable code columns as ``(gentity_id, type_id, value)`` rows, NULLs left out.

    All columns come from one scan.
    """
    key = F.col(key) if isinstance(key, str) else key
    pairs = F.array(
        *[
            F.struct(F.lit(t).alias("type_id"), F.col(c).cast("string").alias("value"))
            for t, c in codes.items()
        ]
    )
    return (
        df.select(key.alias("gentity_id"), F.explode(pairs).alias("_code"))
        .select("gentity_id", "_code.type_id", "_code.value")
        .where(F.col("value").isNotNull())
    )


def with_old_id(df: DataFrame, key: str = "id") -> DataFrame:
    """Keep the source key beside the new one."""
    return df.withColumn("old_id", F.col(key))


def append(target: DataFrame | None, rows: DataFrame) -> DataFrame:
    """Add rows to a table; columns they do not name become NULL.

    Values take the table's types. A column the table does not have is an error.
    """
    if target is None:
        return rows
    unknown = set(rows.columns) - set(target.columns)
    if unknown:
        raise ValueError(f"the table has no column {sorted(unknown)}")
    types = dict(target.dtypes)
    typed = rows.select(*[F.col(c).cast(types[c]).alias(c) for c in rows.columns])
    return target.unionByName(typed, allowMissingColumns=True)


def stack(*tables: DataFrame) -> DataFrame:
    """All rows of all tables; columns a table lacks become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def route_points(
    df: DataFrame, x: str, y: str, latitude: str, longitude: str,
    from_text, projected_srid: int = 2100, degrees_srid: int = 4326,
) -> DataFrame:
    """Choose each station's coordinates: projected, degrees text, or none.

    The three cases exclude each other, so one pass over the source fills
    ``abscissa``, ``ordinate`` and ``srid``. Latitude goes to ``abscissa``.
    ``from_text`` maps (latitude, longitude) to two degree columns.
    """
    route = (
        F.when(F.col(x) != 0, F.lit("projected"))
        .when(F.col(latitude).isNull() | F.col(latitude).isin("", "00 00 00"), F.lit("none"))
        .otherwise(F.lit("degrees"))
    )
    lat, lon = from_text(F.col(latitude), F.col(longitude))
    is_projected, is_degrees = F.col("route") == "projected", F.col("route") == "degrees"
    return df.withColumn("route", route).withColumns(
        {
            "abscissa": F.when(is_projected, F.col(x)).when(is_degrees, lat),
            "ordinate": F.when(is_projected, F.col(y)).when(is_degrees, lon),
            "srid": F.when(is_projected, F.lit(projected_srid)).when(is_degrees, F.lit(degrees_srid)),
        }
    )
