"""One file per series and one file per blob, written by the tasks."""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.operators.documents import PART_BYTES, ordered_parts
from stationflow.session import written


# Names of a file system that Spark's and Arrow's readers spell differently.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


class Written(NamedTuple):
    files: int
    rows: int


def _location(spark: SparkSession, path: str) -> str:
    """The path with its file system spelled out, for use inside tasks."""
    if path.startswith("file:"):
        return "/" + path[len("file:"):].lstrip("/")
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    if "://" not in path:
        path = path if default.startswith("file:") else default.rstrip("/") + path
    scheme, separator, rest = path.partition("://")
    return f"{_SCHEMES.get(scheme, scheme)}://{rest}" if separator else path


def _staged(location: str, mode: str) -> str:
    """A new hidden folder beside ``location`` for files that are not complete yet."""
    from pyarrow import fs

    filesystem, base = fs.FileSystem.from_uri(location)
    if mode != "overwrite" and filesystem.get_file_info(base).type != fs.FileType.NotFound:
        if filesystem.get_file_info(fs.FileSelector(base)):
            raise FileExistsError(location)
    top, _, name = location.rstrip("/").rpartition("/")
    staging = f"{top}/.{name}.{uuid.uuid4().hex}"
    filesystem.create_dir(fs.FileSystem.from_uri(staging)[1], recursive=True)
    return staging


def _publish(staging: str, location: str) -> None:
    """The complete folder in place of what there was."""
    from pyarrow import fs

    filesystem, base = fs.FileSystem.from_uri(location)
    if filesystem.get_file_info(base).type != fs.FileType.NotFound:
        filesystem.delete_dir(base)
    filesystem.move(fs.FileSystem.from_uri(staging)[1], base)


def _discard(staging: str) -> None:
    from pyarrow import fs

    filesystem, base = fs.FileSystem.from_uri(staging)
    filesystem.delete_dir(base)


def _file_task(location: str):
    """A task that writes runs of rows with one file name into that file.

    A run's contents lie side by side in the Arrow buffer and are written from
    there in one piece. Each file gets a hidden temporary name and is renamed
    when complete, so a repeated or lost task never leaves half a file. The
    function is self-contained: executors need no copy of this package.
    """
    def write(batches):
        import uuid

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyarrow import fs

        filesystem, base = fs.FileSystem.from_uri(location)
        attempt = uuid.uuid4().hex
        schema = pa.schema([("file", pa.string()), ("rows", pa.int64())])
        name = stream = None
        count = 0

        def close():
            stream.close()
            filesystem.move(f"{base}/.{name}.{attempt}", f"{base}/{name}")
            return pa.RecordBatch.from_pydict({"file": [name], "rows": [count]}, schema)

        try:
            for batch in batches:
                content = batch.column(1)
                wide = pa.types.is_large_string(content.type) or pa.types.is_large_binary(content.type)
                _, offsets, data = content.buffers()
                offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[content.offset:]
                data = memoryview(data or b"")
                runs = pc.run_end_encode(batch.column(0))
                start = 0
                for file, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                    if file != name:
                        if stream is not None:
                            yield close()
                        name, count = file, 0
                        stream = filesystem.open_output_stream(f"{base}/.{name}.{attempt}")
                    stream.write(data[offsets[start]:offsets[end]])
                    count += end - start
                    start = end
            if stream is not None:
                yield close()
        except BaseException:  # a failed attempt leaves no hidden file
            if stream is not None and not stream.closed:
                stream.close()
                filesystem.delete_file(f"{base}/.{name}.{attempt}")
            raise

    return write


def _join_task(location: str):
    """A task that makes each file of its ordered pieces, of one or many, and deletes these."""
    def join(batches):
        import uuid

        import pyarrow as pa
        from pyarrow import fs

        filesystem, base = fs.FileSystem.from_uri(location)
        attempt = uuid.uuid4().hex
        for batch in batches:
            for name, pieces in zip(batch["file"].to_pylist(), batch["pieces"].to_pylist(), strict=True):
                if filesystem.get_file_info(f"{base}/{name}").type == fs.FileType.NotFound:
                    if len(pieces) == 1:
                        filesystem.move(f"{base}/{pieces[0]}", f"{base}/{name}")
                        continue
                    with filesystem.open_output_stream(f"{base}/.{name}.{attempt}") as out:
                        for piece in pieces:
                            with filesystem.open_input_stream(f"{base}/{piece}") as stream:
                                while data := stream.read(1 << 22):
                                    out.write(data)
                    filesystem.move(f"{base}/.{name}.{attempt}", f"{base}/{name}")
                for info in filesystem.get_file_info([f"{base}/{piece}" for piece in pieces]):
                    if info.type != fs.FileType.NotFound:  # or an earlier attempt has come this far
                        filesystem.delete_file(info.path)
            yield pa.RecordBatch.from_pydict({"file": batch["file"]})

    return join


def _run(df: DataFrame, path: str, mode: str) -> Written:
    """Files of ``(file, content)`` rows, of which each file's lie together: all of them, or none if a task fails."""
    location = _location(df.sparkSession, path)
    staging = _staged(location, mode)
    try:
        listed = df.mapInArrow(_file_task(staging), "file string, rows long")
        total = listed.agg(F.count("*").alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).collect()[0]
        _publish(staging, location)
    except BaseException:
        _discard(staging)
        raise
    return Written(total["files"], total["rows"])


def write_series_dir(
    lines: DataFrame, path: str, mode: str = "error", period: Column | None = None, part_bytes: int = PART_BYTES
) -> Written:
    """``(id, ts, line)`` as files ``NNNNN.data`` with CR LF lines sorted by time.

    The lines of all series are sorted into ranges and make parts of ``part_bytes``, so a
    long series is written by many tasks; one task then puts its parts together, reading
    them as streams. ``period`` is a text that grows with time, such as the year; with it
    a series has a file ``NNNNN.PERIOD.data`` for each period. Readers take the id before
    the first dot either way. ``mode='overwrite'`` replaces the folder. The files show
    when all of them are complete.
    """
    name = F.format_string("%05d.data", "id") if period is None else F.format_string("%05d.%s.data", F.col("id"), period)
    rows = lines.select(
        name.alias("file"), "ts", F.concat(F.coalesce("line", F.lit("")), F.lit("\r\n")).alias("line")
    )
    location = _location(lines.sparkSession, path)
    staging = _staged(location, mode)
    try:
        parts = ordered_parts(rows, ["file"], ["ts"], F.col("line"), sep="", part_bytes=part_bytes)
        piece = F.format_string(".%s.%09d", "file", "part")
        pieces = written(parts.select(piece.alias("piece"), "content").mapInArrow(_file_task(staging), "file string, rows long"), "series-pieces")
        series = F.regexp_extract("file", r"^\.(.*)\.[0-9]{9}$", 1)
        whole = pieces.groupBy(series.alias("file")).agg(F.array_sort(F.collect_list("file")).alias("pieces"))
        files = whole.mapInArrow(_join_task(staging), "file string").count()
        _publish(staging, location)
    except BaseException:
        _discard(staging)
        raise
    return Written(files, lines.count())


def write_blobs(df: DataFrame, path: str, name: Column, blob: str, mode: str = "error") -> Written:
    """One file per row, named by an expression; rows without content or name are skipped.

    Two rows with one name are an error, found before anything is written.
    """
    files = df.select(name.alias("file"), F.col(blob).cast("binary").alias("content"))
    files = files.where(F.col("file").isNotNull() & (F.octet_length("content") > 0))
    repeated = files.groupBy("file").agg(F.count("*").alias("n")).where("n > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"{repeated[0]['n']} rows for the file {repeated[0]['file']}")
    return _run(files, path, mode)
