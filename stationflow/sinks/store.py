"""A store of tables that a load changes all at once, or not at all.

A manifest names the files of every table and the next id of every sequence. A
load writes new files beside the old ones and then, once its checks are passed,
the next manifest under its number: that one rename is the commit. Whatever stops
a load before it, the store is as it was; the files left over belong to no
manifest and go with a later commit. Of two loads at once one commits, the other
is told so. The last manifests stay, with their files.

A table is put as a whole, or kept by a key. Rows of a keyed table lie in buckets
by the low bits of the key's hash, each bucket with as many bits as it needs: a
bucket with too many rows is split when it is written, and a directory of the
buckets is kept with the table (extendible hashing). A change reads and writes the
buckets of its keys; the files of all others stay as they are. A key with more
rows than a bucket holds has a bucket of its own, in several files.

The manifest grows with the number of tables, a directory with the number of
buckets; the driver holds the buckets that a load touches.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stationflow.operators.ids import assign_ids
from stationflow.operators.skew import one_per_key
from stationflow.operators.updates import update_from
from stationflow.session import written

# Rows that a bucket holds, and bits of the hash that are counted at a time.
BUCKET_ROWS, _COUNTED_BITS, _DEEPEST = 20_000_000, 6, 60
_DIRECTORY = "_depth int, _prefix long, _path string, _rows long"
_BUCKET = "store_bucket"

Check = Callable[[Mapping[str, DataFrame]], DataFrame | None]


class IntegrityError(ValueError):
    """References of a load without a row; the store is as before."""

    def __init__(self, violations: dict[str, int]):
        super().__init__(f"references without a row: {violations}")
        self.violations = violations


class ConflictError(RuntimeError):
    """Another load has been committed meanwhile; the store is as that one left it."""


class Manifest(NamedTuple):
    version: int
    tables: dict[str, dict]
    marks: dict[str, int]


class Store:
    """The tables below a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """The numbers of the manifests, oldest first."""
        found = [n.removesuffix(".json") for n in self._names("_manifests")]
        return sorted(int(n) for n in found if n.isdigit())

    def manifest(self, version: int | None = None) -> Manifest:
        """The current manifest, or an earlier one that is still kept."""
        known = self.versions()
        if version is None and not known:
            return Manifest(0, {}, {})
        text = self.spark.read.option("wholetext", True).text(self._manifest_path(version or known[-1])).first()[0]
        return Manifest(**json.loads(text))

    def table(self, name: str, version: int | None = None) -> DataFrame | None:
        """A table as of a manifest, the current one if not given; None if there is none."""
        entry = self.manifest(version).tables.get(name)
        return None if entry is None else self._read(entry)

    def buckets(self, name: str) -> DataFrame:
        """``(bits, rows)`` of each bucket of a keyed table: the bits of the hash that it has, and its rows."""
        return self._directory(self.manifest().tables[name]).select(F.col("_depth").alias("bits"), F.col("_rows").alias("rows"))

    def begin(self) -> Load:
        """A load on top of the current manifest; to be used in ``with``."""
        return Load(self)

    def _read(self, entry: dict, paths: Sequence[str] | None = None) -> DataFrame:
        schema = StructType.fromJson(entry["schema"])
        if "path" in entry:
            paths = [entry["path"]]
        elif paths is None:
            paths = self._paths(entry)
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.folder}/{p}" for p in paths])

    def _directory(self, entry: dict) -> DataFrame:
        return self.spark.read.schema(_DIRECTORY).parquet(f"{self.folder}/{entry['directory']}")

    def _paths(self, entry: dict) -> list[str]:
        """The folders of a keyed table's buckets; an empty bucket has none."""
        return [r["_path"] for r in self._directory(entry).select("_path").where("_path IS NOT NULL").collect()]

    def _manifest_path(self, version: int) -> str:
        return f"{self.folder}/_manifests/{version:010d}.json"

    def _names(self, path: str) -> list[str]:
        top = self._path(f"{self.folder}/{path}" if path else self.folder)
        return [s.getPath().getName() for s in self._files.listStatus(top)] if self._files.exists(top) else []

    def _delete(self, path: str) -> None:
        self._files.delete(self._path(f"{self.folder}/{path}"), True)

    def _publish(self, manifest: Manifest) -> None:
        """The manifest under its number, unless there is one."""
        jvm, target = self.spark._jvm, self._path(self._manifest_path(manifest.version))
        draft = self._path(f"{self.folder}/_manifests/.{manifest.version}-{uuid.uuid4().hex}")
        stream = self._files.create(draft, False)
        stream.write(bytearray(json.dumps(manifest._asdict()).encode()))
        stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files.getUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(self._files.makeQualified(draft), self._files.makeQualified(target), options)
        except Py4JJavaError as error:
            self._files.delete(draft, False)
            if self._files.exists(target):
                raise ConflictError(f"version {manifest.version} has been committed by another load") from error
            raise

    def _vacuum(self, keep: int) -> None:
        """Delete manifests but the last ones, and all files of finished loads that none of these names."""
        known = self.versions()
        kept = [self.manifest(v) for v in known[-keep:]]
        named: set[str] = set()
        for entry in {json.dumps(e): e for m in kept for e in m.tables.values()}.values():
            if "path" in entry:
                named.add(entry["path"])
            else:
                named.add(entry["directory"])
                named.update(self._paths(entry))
        folders = {p.split("/")[0] + "/" + p.split("/")[1] for p in named}
        for version in known[:-keep]:
            self._delete(f"_manifests/{version:010d}.json")
        for table in self._names(""):
            for load in [] if table == "_manifests" else self._names(table):
                begun = re.match(r"v(\d+)-", load)
                if begun is None or int(begun[1]) > known[-1]:
                    continue  # of a load that goes on, or none of ours
                if f"{table}/{load}" not in folders:
                    self._delete(f"{table}/{load}")
                    continue
                for bucket in self._names(f"{table}/{load}"):
                    if bucket.startswith(f"{_BUCKET}=") and f"{table}/{load}/{bucket}" not in named:
                        self._delete(f"{table}/{load}/{bucket}")


class Load(Mapping[str, DataFrame]):
    """New states of some tables, seen by this load alone until it is committed."""

    def __init__(self, store: Store):
        self.store, self.base = store, store.manifest()
        self.tables, self.marks = dict(self.base.tables), dict(self.base.marks)
        self._folder = f"v{self.base.version + 1}-{uuid.uuid4().hex[:12]}"
        self._written: list[str] = []
        self._writes = 0

    def __enter__(self) -> Load:
        return self

    def __exit__(self, *_: object) -> None:
        self.discard()

    def __getitem__(self, name: str) -> DataFrame:
        return self.store._read(self.tables[name])

    def __contains__(self, name: object) -> bool:
        return name in self.tables

    def __iter__(self) -> Iterator[str]:
        return iter(self.tables)

    def __len__(self) -> int:
        return len(self.tables)

    def put(self, name: str, table: DataFrame) -> DataFrame:
        """A whole table in place of what there was; it may be computed from that. Returns it as stored."""
        path = self._new_folder(name)
        table.write.parquet(f"{self.store.folder}/{path}")
        self.tables[name] = {"path": path, "schema": _nullable(table)}
        return self[name]

    def replace(self, name: str, key: str, rows: DataFrame, bucket_rows: int = BUCKET_ROWS) -> None:
        """Rows in place of all stored ones with their keys. A row without key is an error."""
        rows = written(rows, "replacing")
        keys = _keys(rows, key)
        self._change(name, key, rows, keys, lambda old: old.join(_held(keys), F.col(key) == F.col("_held"), "left_anti").unionByName(rows), bucket_rows)

    def merge(
        self, name: str, key: str, rows: DataFrame, sets: Mapping[str, Column], order: Sequence[str] | None = None,
        insert: bool = True, bucket_rows: int = BUCKET_ROWS,
    ) -> None:
        """Stored rows with a key of ``rows`` are updated as ``update_from`` does; other keys' rows are added.

        Of several rows with one key the lowest by ``order``, or by all columns, counts.
        """
        rows = written(rows, "merging")
        keys = _keys(rows, key)

        def merged(old: DataFrame) -> DataFrame:
            changed = update_from(old, rows, {key: key}, sets, order)
            if not insert:
                return changed
            whole = F.struct(*rows.columns)
            best = F.min_by(whole, F.struct(*order)) if order else F.min(whole)
            first = rows.groupBy(F.col(key).alias("_key")).agg(best.alias("_row")).select("_row.*")
            have = one_per_key(old.select(F.col(key).alias("_held")), ["_held"])
            added = first.join(have, F.col(key) == F.col("_held"), "left_anti").select(*[c for c in old.columns if c in first.columns])
            return changed.unionByName(added, allowMissingColumns=True)

        self._change(name, key, rows, keys, merged, bucket_rows)

    def delete(self, name: str, key: str, rows: DataFrame) -> None:
        """The stored rows whose key occurs in ``rows`` go. Their ids aren't given again."""
        keys = _keys(rows, key)
        entry = self.tables[name]
        if "path" in entry:
            self.put(name, self[name].join(_held(keys), F.col(key) == F.col("_held"), "left_anti"))
        else:
            self._change(name, key, self[name].limit(0), keys, lambda old: old.join(_held(keys), F.col(key) == F.col("_held"), "left_anti"), entry["bucket_rows"])

    def number(self, name: str, rows: DataFrame, order: Sequence[str], key: str = "id", unique: bool = False) -> DataFrame:
        """The rows with the next ids of a sequence, in order; its mark moves past them."""
        numbered = assign_ids(rows, order, self._mark(name), key, unique)
        self.reserve(name, numbered.count())
        return numbered

    def reserve(self, name: str, count: int) -> int:
        """The first of ``count`` new ids in a row, given to nobody else once this load is committed."""
        first = self._mark(name)
        self.marks[name] = first + count
        return first

    def _mark(self, name: str) -> int:
        """The next id. A sequence begins after the ids of its table, which is searched only then."""
        if name not in self.marks and name in self.tables and "id" in self[name].columns:
            self.observe(name, self[name])
        return self.marks.get(name, 1)

    def observe(self, name: str, rows: DataFrame, key: str = "id") -> None:
        """Rows that bring their ids: the sequence goes on after them."""
        top = rows.agg(F.max(F.col(key).cast("long"))).first()[0]
        if top is not None:
            self.marks[name] = max(self.marks.get(name, 1), top + 1)

    def commit(self, check: Check | None = None, dry_run: bool = False, keep: int = 2) -> dict[str, int]:
        """Make this load the state of the store; returns what ``check`` found, which is nothing then.

        ``check`` takes all tables as they would be and gives ``(reference, violations)``
        rows, such as ``plans.common.violations``. Any violation discards the load and is
        an error. ``dry_run`` discards it in any case and returns the violations.
        """
        report = None if check is None else check(self)
        found = {} if report is None else {r["reference"]: r["violations"] for r in report.where("violations > 0").collect()}
        if found or dry_run:
            self.discard()
            if dry_run:
                return found
            raise IntegrityError(found)
        self.store._publish(Manifest(self.base.version + 1, self.tables, self.marks))
        self._written = []
        self.store._vacuum(keep)
        return found

    def discard(self) -> None:
        """Delete what this load has written, unless it is committed."""
        for path in self._written:
            self.store._delete(path)
        self._written = []
        self.tables, self.marks = dict(self.base.tables), dict(self.base.marks)

    def _new_folder(self, name: str) -> str:
        self._writes += 1
        self._written.append(f"{name}/{self._folder}-{self._writes}")
        return self._written[-1]

    def _change(self, name: str, key: str, like: DataFrame, keys: DataFrame, content: Callable[[DataFrame], DataFrame], bucket_rows: int) -> None:
        """New content for the buckets of some keys, of a table that begins with the columns of ``like``."""
        spark, folder = self.store.spark, self._new_folder(name)
        entry = self.tables.get(name)
        if entry is not None and "path" in entry:
            raise ValueError(f"{name} is not kept by a key")
        if entry is None:
            entry = {"key": key, "bucket_rows": bucket_rows, "schema": _nullable(like)}
            directory, touched = spark.createDataFrame([(0, 0, None, 0)], _DIRECTORY), [(0, 0, None)]
        else:
            if entry["key"] != key:
                raise ValueError(f"{name} is kept by {entry['key']}")
            directory = self.store._directory(entry)
            depths = [r["_depth"] for r in directory.select("_depth").distinct().collect()]
            hashed = keys.select(F.xxhash64(F.col("_key").cast(StructType.fromJson(entry["schema"])[key].dataType)).alias("_hash"))
            touched = [tuple(r) for r in _placed(hashed, directory, depths).select("_depth", "_prefix", "_path").distinct().collect()]
        if not touched:
            return
        schema = StructType.fromJson(entry["schema"])
        old = self.store._read(entry, [p for _, _, p in touched if p is not None])
        rows = content(old).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
        rows = written(rows.withColumn("_hash", F.xxhash64(key)), "changed")
        leaves = _split(rows, [(d, p) for d, p, _ in touched], entry["bucket_rows"])
        paths = [(d, p, f"{folder}/{_BUCKET}={d}-{p}" if n else None, n) for (d, p), n in leaves.items()]
        listed = F.broadcast(spark.createDataFrame(paths, _DIRECTORY))  # the driver's own list
        new = _placed(rows, listed, sorted({d for d, _ in leaves})).withColumn(_BUCKET, F.concat_ws("-", "_depth", "_prefix"))
        rest = [f.name for f in schema if f.name != key and f.dataType.typeName() not in ("map", "variant")]
        # Rows of one key spread over tasks by a hash of the others, so no payload is in the sampled bounds.
        spread = new.repartitionByRange(_BUCKET, key, F.xxhash64(*rest) if rest else F.lit(0)).sortWithinPartitions(_BUCKET, key, *rest)
        spread.select(*schema.names, _BUCKET).write.partitionBy(_BUCKET).parquet(f"{self.store.folder}/{folder}")
        gone = F.broadcast(spark.createDataFrame([(d, p) for d, p, _ in touched], "_depth int, _prefix long"))
        left = directory.join(gone, ["_depth", "_prefix"], "left_anti").unionByName(listed)
        path = f"{folder}/directory"
        left.coalesce(1).write.parquet(f"{self.store.folder}/{path}")
        self.tables[name] = entry | {"directory": path}


def _nullable(table: DataFrame) -> dict:
    """The schema as files give it back."""
    schema = table.schema.jsonValue()
    for field in schema["fields"]:
        field["nullable"] = True
    return schema


def _keys(rows: DataFrame, key: str) -> DataFrame:
    value = F.when(F.col(key).isNull(), F.raise_error(F.lit(f"a row without {key}")).cast(rows.schema[key].dataType))
    return rows.select(value.otherwise(F.col(key)).alias("_key")).distinct()


def _held(keys: DataFrame) -> DataFrame:
    return one_per_key(keys.select(F.col("_key").alias("_held")), ["_held"])


def _placed(rows: DataFrame, buckets: DataFrame, depths: Sequence[int]) -> DataFrame:
    """The rows with their bucket's columns: of the buckets of all depths, the one whose bits their ``_hash`` ends in."""
    places = [F.struct(F.lit(d).alias("_depth"), F.col("_hash").bitwiseAND(F.lit((1 << d) - 1)).alias("_prefix")) for d in depths]
    return rows.withColumn("_place", F.explode(F.array(*places))).select("*", "_place.*").drop("_place").join(buckets, ["_depth", "_prefix"])


def _split(rows: DataFrame, buckets: Sequence[tuple[int, int]], most: int) -> dict[tuple[int, int], int]:
    """``(depth, prefix)`` of the buckets that hold the rows, with their number: the given ones, split until none is too large.

    Rows are counted by the next bits of their hash. What can't be parted, because all
    have one hash, stays together.
    """
    leaves: dict[tuple[int, int], int] = dict.fromkeys(buckets, 0)
    spark, pending = rows.sparkSession, list(buckets)
    while pending:
        listed = F.broadcast(spark.createDataFrame(pending, "_depth int, _prefix long"))
        held = _placed(rows.select("_hash"), listed, sorted({d for d, _ in pending}))
        next_bits = F.call_function("shiftrightunsigned", F.col("_hash"), F.col("_depth")).bitwiseAND(F.lit((1 << _COUNTED_BITS) - 1))
        counts = held.groupBy("_depth", "_prefix", next_bits.alias("_bits")).agg(F.count("*").alias("n"), (F.min("_hash") == F.max("_hash")).alias("one"))
        cells: dict[tuple[int, int], list[tuple[int, int, bool]]] = {}
        for r in counts.collect():
            cells.setdefault((r["_depth"], r["_prefix"]), []).append((r["_bits"], r["n"], r["one"]))
        pending = []
        for (depth, prefix), cell in cells.items():
            del leaves[depth, prefix]
            parts = [(0, 0, cell)]
            while parts:
                taken, bits, inside = parts.pop()
                place, total = (depth + taken, prefix | bits << depth), sum(n for _, n, _ in inside)
                whole = total <= most or (len(inside) == 1 and inside[0][2]) or depth + taken >= _DEEPEST
                if whole or taken == _COUNTED_BITS:
                    leaves[place] = total
                    if not whole:
                        pending.append(place)
                    continue
                for bit in (0, 1):  # a half without rows is a bucket too: later rows find their place
                    parts.append((taken + 1, bits | bit << taken, [c for c in inside if c[0] >> taken & 1 == bit]))
    return leaves
