"""Document keys and texts on their way through shuffles; written tables come from the session."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F, types as T

from stationflow.session import work_dir as new_folder, written as staged

__all__ = ["keyed", "new_folder", "opened", "squeezed", "staged", "text_bytes", "unique_ids"]

#: Text held at a time where squeezed texts are opened.
OPENED_BYTES = 16 << 20


def text_bytes(column: Column) -> Column:
    """A text as its UTF-8 bytes; a null text is empty."""
    return F.coalesce(column, F.lit("")).cast("binary")


def keyed(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """``_id``, ``_key``, ``_text`` and ``more`` columns of each row.

    ``_key`` is the id where ids are whole numbers, present and unique. Otherwise
    it is a hash of id and text, so that rows that share an id stay apart unless
    they are equal in both; equal rows share a key, and with it their result.
    """
    rows = docs.select(F.col(id_col).alias("_id"), text_bytes(F.col(text_col)).alias("_text"), *more)
    if unique_ids(docs, id_col):
        return rows.select("_id", F.col("_id").cast("long").alias("_key"), "_text", *more)
    return rows.select("_id", F.xxhash64("_id", "_text").alias("_key"), "_text", *more)


def unique_ids(docs: DataFrame, id_col: str) -> bool:
    """Whether every row has a whole number of its own in ``id_col``."""
    if not isinstance(docs.schema[id_col].dataType, (T.LongType, T.IntegerType, T.ShortType)):
        return False
    repeated = docs.groupBy(id_col).count().filter((F.col("count") > 1) | F.col(id_col).isNull())
    return repeated.isEmpty()


def squeezed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_text`` compressed, text by text, before they are shuffled."""
    return rows.mapInArrow(_squeeze, rows.schema)


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    coder = zstandard.ZstdCompressor(level=3, write_checksum=False)
    for batch in batches:
        texts = pa.array([coder.compress(x) for x in batch["_text"].to_pylist()], pa.binary())
        yield batch.set_column(batch.schema.get_field_index("_text"), "_text", texts)


def opened(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[pa.RecordBatch]:
    """Batches of squeezed texts with the texts as they were, a few megabytes at a time."""
    coder = zstandard.ZstdDecompressor()
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            to, size = at, 0
            while to < batch.num_rows and (to == at or size < OPENED_BYTES):
                size += sum(zstandard.frame_content_size(batch[name][to].as_buffer()) for name in columns)
                to += 1
            part = batch.slice(at, to - at)
            for name in columns:
                texts = pa.array([coder.decompress(x) for x in part[name].to_pylist()], pa.binary())
                part = part.set_column(part.schema.get_field_index(name), name, texts)
            yield part
            at = to
