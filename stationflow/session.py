"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

_FOLDERS: list[tuple[SparkSession, str]] = []


def local_session(cores: str = "8", app: str = "stationflow") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master gets a temporary folder of its own when the setting is
    missing; a cluster without the setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="stationflow-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared one, for one run's files; ``release`` deletes it."""
    if not _FOLDERS:
        atexit.register(release)
    folder = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _FOLDERS.append((spark, folder))
    return folder


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read from there.

    Used where a later step must see exactly the rows and partition numbers of
    an earlier one, also after an executor is lost, or where a table is read again.
    """
    folder = work_dir(df.sparkSession, label)
    df.write.parquet(folder)
    stored = df.sparkSession.read.schema(df.schema).parquet(folder)
    stored._work_folder = folder
    return stored


def mark() -> int:
    """A point in the process; ``release`` takes it for the folders made since."""
    return len(_FOLDERS)


def release(since: int = 0, keep: Iterable[DataFrame] = ()) -> None:
    """Delete the work folders made after a ``mark``, but those that hold a written table of ``keep``.

    Results that still read the others must be stored before. Without arguments all
    folders of the process go, as they do when it ends.
    """
    kept = {getattr(df, "_work_folder", None) for df in keep}
    gone = [entry for entry in _FOLDERS[since:] if entry[1] not in kept]
    _FOLDERS[since:] = [entry for entry in _FOLDERS[since:] if entry[1] in kept]
    for spark, folder in gone:
        try:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        except (AttributeError, OSError, Py4JError):  # the session has ended before
            continue
