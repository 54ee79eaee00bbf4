"""Hard negatives of anchors, scored by the method of Four Russians.

Components are scaled to whole numbers. A candidate is kept as bit planes: bit k of
eight components is one byte, the highest plane being the sign's. For an anchor and
each group of eight dimensions a table holds the sums of all 256 subsets of the
anchor's eight components, each made from a smaller one by one addition. A score is
then added up from looked-up sums, plane by plane from the highest, doubling what
there is before each next plane: the whole inner product, exact.

Anchors come in slices of about ANCHORS, all rows are read for each slice, and
inside a task a slice is scored BLOCK anchors at a time against a batch. That is
the stated query set against all rows, in blocks; no row is shuffled for it. A task
keeps the best entries of each list only, so what leaves it does not follow its rows,
and the lists of the tasks are ranked by a window that drops the rest before its
shuffle. The first pass finds each anchor's positives, the best rows of its label;
the second one finds, for each positive, the best rows of other labels whose score
lies between two shares of the positive's.

What the driver holds is one slice: its planes, and up to ``positives`` scores for
each of its anchors.

Higher scores come first, ties by the smaller id. A row without id, label or vector,
with a null or non-finite component, or whose vector is not of the length that most
have, takes no part. Rows that share an id are one row, the lowest by label and
vector. An anchor without positives has no rows, nor has a positive without rows in
its range, as when its score is negative. An empty table, or one without anchors,
gives an empty result. Other columns, clashing or not, aren't read. Components so
large that a score could pass 64 bits are an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from stationflow.llm.staging import staged, unique_ids
from stationflow.llm.vectors import matrix, usable

#: Anchors whose planes are sent to the tasks at once and that are scored together; rows of a task, and of a batch.
ANCHORS, BLOCK, TASK_ROWS, BATCH = 16_384, 64, 1 << 20, 4096
_NONE = -(1 << 62)


def hard_negatives(
    vectors: DataFrame, anchor: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
    scale: int = 256, positives: int = 5, negatives: int = 10, shares: tuple[int, int] = (30, 90),
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchor`` says which ids are anchors, as a condition on the id column. A negative's
    score is at least ``shares[0]`` and at most ``shares[1]`` hundredths of the positive's.
    """
    spark = vectors.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    rows, dim = usable(rows, vector_col, F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), anchor.alias("anchor"))
    if not dim:
        return spark.createDataFrame([], schema)
    if not unique_ids(rows, "id"):
        rows = rows.groupBy("id").agg(F.min(F.struct("label", "_v", "anchor")).alias("_row")).select("id", "_row.*")
    least, most, count = rows.agg(F.min(F.array_min("_v")), F.max(F.array_max("_v")), F.count("*")).first()
    bits = _bits(math.floor(scale * least), math.floor(scale * most))
    if dim << (2 * bits - 2) >= 1 << 48:
        raise OverflowError("scores beyond 64 bits")

    def planes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = _packed(np.floor(scale * matrix(batch["_v"], dim)).astype(np.int64), bits)
            yield pa.RecordBatch.from_arrays([batch["id"], batch["label"], batch["anchor"], pa.array([x.tobytes() for x in packed], pa.binary())], names=["id", "label", "anchor", "planes"])

    tasks = max(spark.sparkContext.defaultParallelism, count // TASK_ROWS + 1)
    packed = staged(rows.mapInArrow(planes, "id long, label long, anchor boolean, planes binary").repartition(tasks), "planes")
    anchors = packed.filter("anchor")
    slices = anchors.count() // ANCHORS + 1
    found = [_mined(packed, anchors.filter(F.pmod(F.xxhash64("id"), F.lit(slices)) == s), bits, dim, positives, negatives, shares) for s in range(slices)]
    return reduce(DataFrame.unionByName, found).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _bits(least: int, most: int) -> int:
    """Bits of a two's complement that holds both."""
    return max((-least - 1 if least < 0 else least).bit_length(), (-most - 1 if most < 0 else most).bit_length()) + 1


def _packed(x: np.ndarray, bits: int) -> np.ndarray:
    """(row, plane, group) bytes: bit ``plane`` of eight components, as a row of bytes for each vector."""
    planes = (x[:, None, :] >> np.arange(bits)[None, :, None]) & 1
    return np.packbits(planes.astype(np.uint8), axis=2, bitorder="little")


def _unpacked(planes: np.ndarray, dim: int) -> np.ndarray:
    """The whole numbers of (row, plane, group) bytes."""
    ones = np.unpackbits(planes, axis=2, bitorder="little").astype(np.int64)
    weights = 1 << np.arange(planes.shape[1], dtype=np.int64)
    weights[-1] *= -1
    return np.einsum("rpd,p->rd", ones, weights)


def _bytes(column: pa.Array, bits: int, groups: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), bits, groups)


def subset_tables(x: np.ndarray) -> np.ndarray:
    """(group, 256, anchor): the sums of every subset of an anchor's eight components."""
    anchors, dim = x.shape
    out = np.zeros((dim // 8, 256, anchors), np.int64)
    for i in range(8):
        out[:, 1 << i : 2 << i] = out[:, : 1 << i] + x[:, i::8].T[:, None, :]
    return out


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(candidate, anchor): inner products, from the highest plane down by doubling and adding looked-up sums."""
    rows, bits, groups = planes.shape
    out, part = np.zeros((rows, tables.shape[2]), tables.dtype), np.empty((rows, tables.shape[2]), tables.dtype)
    for k in range(bits - 1, -1, -1):
        out += out
        for g in range(groups):
            np.take(tables[g], planes[:, k, g], axis=0, out=part, mode="clip")
            if k == bits - 1:
                out -= part
            else:
                out += part
    return out


class _Lists:
    """The best ``k`` (score, id) of each of some lists; higher scores and then smaller ids are better."""

    def __init__(self, lists: int, k: int) -> None:
        self.score, self.id = np.full((lists, k), _NONE), np.zeros((lists, k), np.int64)

    def add(self, at: slice, lists: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Entries for the lists from ``at.start`` on."""
        old_score, old_id = self.score[at], self.id[at]
        n, k = old_score.shape
        lists = np.concatenate([np.repeat(np.arange(n), k), lists])
        score, ids = np.concatenate([old_score.ravel(), score]), np.concatenate([old_id.ravel(), ids])
        order = np.lexsort((ids, -score, lists))
        lists, score, ids = lists[order], score[order], ids[order]
        rank = np.arange(len(lists)) - np.searchsorted(lists, np.arange(n))[lists]
        kept = rank < k
        old_score[lists[kept], rank[kept]], old_id[lists[kept], rank[kept]] = score[kept], ids[kept]


def _scored(batches: Iterator[pa.RecordBatch], anchors: np.ndarray, bits: int) -> Iterator[tuple]:
    """(ids, labels, anchors of a block, their scores) for each batch and each block of anchors."""
    kind = np.int32 if anchors.shape[1] << (2 * bits - 2) < 1 << 31 else np.int64
    for whole in batches:
        for at in range(0, whole.num_rows, BATCH):
            batch = whole.slice(at, BATCH)
            ids, labels = batch["id"].to_numpy(), batch["label"].to_numpy()
            planes = _bytes(batch["planes"], bits, anchors.shape[1] // 8)
            for first in range(0, len(anchors), BLOCK):
                block = slice(first, min(first + BLOCK, len(anchors)))
                yield ids, labels, block, scores(subset_tables(anchors[block]).astype(kind), planes)


def _mined(packed: DataFrame, anchors: DataFrame, bits: int, dim: int, positives: int, negatives: int, shares: tuple[int, int]) -> DataFrame:
    """The rows of one slice of anchors, whose ids, labels and planes are sent to the tasks."""
    groups = -(-dim // 8)
    own = anchors.select("id", "label", "planes").toArrow().combine_chunks()
    ids, labels = own["id"].to_numpy(), own["label"].to_numpy()
    x = _unpacked(_bytes(own["planes"], bits, groups), dim)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Lists(len(ids), positives)
        for their, label, block, score in _scored(batches, x, bits):
            wanted = (label[:, None] == labels[block]) & (their[:, None] != ids[block]) & (score >= best.score[block, -1])
            row, column = np.nonzero(wanted)
            best.add(block, column, score[row, column].astype(np.int64), their[row])
        anchor, place = np.nonzero(best.score > _NONE)
        yield pa.RecordBatch.from_pydict({"anchor_id": ids[anchor], "positive_id": best.id[anchor, place], "positive_score": best.score[anchor, place]})

    ranked = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    found = packed.mapInArrow(near, "anchor_id long, positive_id long, positive_score long").withColumn("place", F.row_number().over(ranked)).filter(F.col("place") <= positives)
    listed = found.toArrow()
    order = np.argsort(ids)
    owner = order[np.searchsorted(ids, listed["anchor_id"].to_numpy(), sorter=order)] if len(ids) else np.zeros(0, np.int64)
    target = np.zeros((len(ids), positives), np.int64)
    low, high = np.full((len(ids), positives), 1), np.zeros((len(ids), positives), np.int64)
    place, value = listed["place"].to_numpy() - 1, listed["positive_score"].to_numpy()
    target[owner, place] = listed["positive_id"].to_numpy()
    low[owner, place], high[owner, place] = -(-shares[0] * value // 100), shares[1] * value // 100
    known = np.zeros((len(ids), positives), np.int64)
    known[owner, place] = value

    def hard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Lists(len(ids), negatives) for _ in range(positives)]
        for their, label, block, score in _scored(batches, x, bits):
            other = (label[:, None] != labels[block]) & (their[:, None] != ids[block])
            for p in range(positives):
                wanted = other & (score >= np.maximum(low[block, p], best[p].score[block, -1])) & (score <= high[block, p])
                row, column = np.nonzero(wanted)
                if len(row):
                    best[p].add(block, column, score[row, column].astype(np.int64), their[row])
        for p in range(positives):
            anchor, rank = np.nonzero(best[p].score > _NONE)
            yield pa.RecordBatch.from_pydict({
                "anchor_id": ids[anchor], "positive_id": target[anchor, p], "positive_score": known[anchor, p],
                "negative_id": best[p].id[anchor, rank], "negative_score": best[p].score[anchor, rank],
            })

    schema = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    ranked = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return staged(packed.mapInArrow(hard, schema).withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= negatives), "negatives")


def negatives_sql(table: str) -> str:
    """The result for anchors of ids divisible by 100, as the query deals with labels, in SQL."""
    return f"""
    WITH v AS (
        SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
        FROM {table}
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    ),
    scored AS (
        SELECT a.id AS anchor_id, b.id AS id, a.label = b.label AS same, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
        FROM v AS a JOIN v AS b ON a.id <> b.id AND a.id % 100 = 0
    ),
    positives AS (
        SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
    )
    SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
           id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY rank <= 10
    """
