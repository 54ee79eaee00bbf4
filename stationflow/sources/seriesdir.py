"""Folders with one text file per series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.functions.text import id_from_file_name
from stationflow.operators.series import parsed_records


def read_series_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(id, line)``: the id is the number before the first dot of the file name.

    Large files are split over several tasks and small ones packed together.
    """
    return spark.read.option("pathGlobFilter", "*.data").text(path).select(
        id_from_file_name("_metadata.file_name").alias("id"), F.col("value").alias("line")
    )


def read_series_dir(spark: SparkSession, path: str) -> DataFrame:
    """``(id, ts, value, flags)`` records of all series files."""
    return parsed_records(read_series_lines(spark, path))
