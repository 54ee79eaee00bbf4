"""Quality classifier by importance resampling.

Two generative models of hashed n-grams, one of clean target text and one of all
raw text, give each document the weight log p_target - log p_raw. Gumbel noise is
added and the k largest sums are kept, which samples k documents without
replacement in proportion to their weights.

N-grams are single words and word pairs, and the same for word shapes (capitals,
digits, signs, length, final sign, repetition of the words before), so text of
unknown words still shows its form. Each kind has a table of buckets of fixed
size with add-one smoothing; the two tables are all that reaches the driver.

The raw model counts every document. The target model is fitted on a bounded,
documented sample: the ``sample`` labelled documents of lowest hash, those whose
label says clean. ``k`` is the expected number of clean documents: every document
counts with its posterior, the labelled share of clean documents times its
weight, at most one. The k-th largest sum is found exactly by histograms, without
a global sort; rows that tie with it are kept together.

A null or empty text has weight 0. Without labels there is no target and every
document is kept. A document with several labels is clean if all say so. Rows
that repeat an id have the same noise and, with equal texts, the same fate. Texts are
read in slices of a megabyte, a longer one as a slice of its own. An empty table gives
an empty result. ``importance`` reads the id and the text only; ``resample`` returns all
columns, of which those named like its two results give way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from stationflow.llm.staging import staged, text_bytes
from stationflow.llm.tokens import Words, mix, words

WORD_BUCKETS, SHAPE_BUCKETS = 1 << 14, 1 << 12
#: Bytes of text whose n-grams a task holds at a time.
_SLICE = 1 << 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SIGN = np.zeros(256, bool)
_SIGN[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


def importance(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 20_000, seed: int = 17) -> DataFrame:
    """(id, log_weight, resample_key, kept) of every document."""
    scored, threshold = _scored(docs, labels, id_col, text_col, sample, seed)
    return scored.withColumn("kept", F.col("resample_key") >= F.lit(threshold))


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 20_000, seed: int = 17) -> DataFrame:
    """The kept documents with their columns, ``log_weight`` and ``resample_key``.

    Documents are scored again where they are read, so their texts are not shuffled.
    """
    model = _fit(docs, labels, id_col, text_col, sample)
    _, threshold = _ranked(docs, labels, model, id_col, text_col, seed)
    docs = docs.drop("log_weight", "resample_key")
    schema = StructType([*docs.schema.fields]).add("log_weight", "double")
    scored = docs.mapInArrow(lambda batches: _weights(batches, model, text_col, keep=True), schema)
    return scored.withColumn("resample_key", _key(id_col, seed)).filter(F.col("resample_key") >= F.lit(threshold))


def _scored(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample: int, seed: int) -> tuple[DataFrame, float]:
    return _ranked(docs, labels, _fit(docs, labels, id_col, text_col, sample), id_col, text_col, seed)


def _verdicts(labels: DataFrame, id_col: str) -> DataFrame:
    return labels.filter(F.col("quality").isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min("quality").alias("clean"))


def _fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample: int) -> np.ndarray:
    """log p_target - log p_raw of each bucket."""
    chosen = _verdicts(labels, id_col).orderBy(F.xxhash64(id_col), id_col).limit(sample).filter("clean = 1").select(F.col(id_col).alias("_id"))
    rows = docs.select(F.col(id_col).alias("_id"), text_bytes(F.col(text_col)).alias("_bytes"))
    flagged = rows.join(F.broadcast(chosen.withColumn("_target", F.lit(True))), "_id", "left").select("_bytes", F.coalesce("_target", F.lit(False)).alias("_target"))
    counts = flagged.mapInArrow(_counts, "bucket int, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    table = np.zeros((2, WORD_BUCKETS + SHAPE_BUCKETS))
    table[:, counts["bucket"].to_numpy()] = np.stack([counts["raw"], counts["target"]])
    if not table[1].any():
        return np.zeros(table.shape[1])
    out = np.empty(table.shape[1])
    for part in (slice(0, WORD_BUCKETS), slice(WORD_BUCKETS, None)):
        smoothed = table[:, part] + 1
        raw, target = np.log(smoothed / smoothed.sum(1, keepdims=True))
        out[part] = target - raw
    return out


def _ranked(docs: DataFrame, labels: DataFrame, model: np.ndarray, id_col: str, text_col: str, seed: int) -> tuple[DataFrame, float]:
    """(id, log_weight, resample_key) of every document, and the smallest key that is kept."""
    schema = docs.select(id_col).schema.add("log_weight", "double")
    rows = docs.select(id_col, text_bytes(F.col(text_col)).alias("_bytes"))
    scored = staged(rows.mapInArrow(lambda batches: _weights(batches, model, "_bytes", keep=False), schema).withColumn("resample_key", _key(id_col, seed)), "weights")
    share = _verdicts(labels, id_col).agg(F.avg("clean")).first()[0]
    if share is None or not model.any():
        return scored, float("-inf")
    posterior = F.least(F.lit(1.0), F.lit(float(share)) * F.exp(F.least("log_weight", F.lit(50.0))))
    n, expected = scored.agg(F.count("*"), F.sum(posterior)).first()
    k = min(n, int(np.ceil(expected or 0)))
    return scored, kth_largest(scored, "resample_key", k) if k else float("inf")


def _key(id_col: str, seed: int):
    """Weight plus standard Gumbel noise, a function of the id alone."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), id_col), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return F.col("log_weight") - F.log(-F.log(uniform))


def kth_largest(rows: DataFrame, column: str, k: int, bins: int = 1024) -> float:
    """The exact k-th largest value, from a histogram of ever narrower ranges."""
    value = F.col(column)
    low, high = rows.agg(F.min(value), F.max(value)).first()
    while low < high:
        place = F.least(F.floor((value - F.lit(low)) / F.lit(high - low) * bins), F.lit(bins - 1))
        counts = rows.filter(value.between(low, high)).groupBy(place.alias("bin")).agg(F.count("*").alias("n"), F.min(value).alias("low"), F.max(value).alias("high")).collect()
        for row in sorted(counts, key=lambda r: -r["bin"]):
            if row["n"] >= k:
                low, high = row["low"], row["high"]
                break
            k -= row["n"]
    return low


def _features(w: Words) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Buckets of the n-grams, and of each the number of the word it begins with."""
    n = len(w.starts)
    pair = np.arange(n - 1)[w.doc_of_word()[1:] == w.doc_of_word()[:-1]] if n else np.arange(0)
    shapes = _shapes(w)
    word = np.arange(n)
    return [
        (w.hashes & np.uint64(WORD_BUCKETS - 1)).astype(np.int64),
        (mix(w.hashes[pair] * _MULTIPLIER + w.hashes[pair + 1]) & np.uint64(WORD_BUCKETS - 1)).astype(np.int64),
        WORD_BUCKETS + (mix(shapes) & np.uint64(SHAPE_BUCKETS - 1)).astype(np.int64),
        WORD_BUCKETS + (mix(shapes[pair] * _MULTIPLIER + shapes[pair + 1] + np.uint64(1)) & np.uint64(SHAPE_BUCKETS - 1)).astype(np.int64),
    ], [word, pair, word, pair]


def _shapes(w: Words) -> np.ndarray:
    """A number for each word's form and whether it repeats one of the two words before."""
    def count(kind: np.ndarray) -> np.ndarray:
        total = np.concatenate([np.zeros(1, np.int32), np.cumsum(kind, dtype=np.int32)])
        return np.minimum(total[w.ends] - total[w.starts], 3)

    out = count((w.data >= 65) & (w.data <= 90))
    out = out * 4 + count((w.data >= 48) & (w.data <= 57))
    out = out * 4 + count(_SIGN[w.data])
    out = out * 4 + np.minimum((w.ends - w.starts) // 4, 3)
    last = w.data[w.ends - 1].astype(np.int64) if len(w.ends) else np.zeros(0, np.int64)
    out = out * 256 + np.where(_SIGN[last], last, 0)
    again = np.zeros(len(w.starts), np.int64)
    again[1:] = w.hashes[1:] == w.hashes[:-1]
    again[2:] |= (w.hashes[2:] == w.hashes[:-2]).astype(np.int64) << 1
    return (out * 4 + again).astype(np.uint64)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    size = WORD_BUCKETS + SHAPE_BUCKETS
    raw, target = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for batch in batches:
        flags = batch["_target"].to_numpy(zero_copy_only=False)
        for w in words(batch["_bytes"], most=_SLICE):
            chosen = np.repeat(flags[w.rows.start : w.rows.stop], w.counts)
            for buckets, begin in zip(*_features(w), strict=True):
                raw += np.bincount(buckets, minlength=size)
                target += np.bincount(buckets[chosen[begin]], minlength=size)
    used = np.flatnonzero(raw)
    yield pa.RecordBatch.from_pydict({"bucket": used.astype(np.int32), "raw": raw[used], "target": target[used]})


def _weights(batches: Iterator[pa.RecordBatch], model: np.ndarray, column: str, keep: bool) -> Iterator[pa.RecordBatch]:
    """The rows with their log weight; the texts go to the task once, and ``keep`` says they come back."""
    for batch in batches:
        out = np.zeros(batch.num_rows)
        for w in words(batch[column].cast(pa.binary()).fill_null(b""), most=_SLICE):
            total = np.zeros(len(w.starts) + 1)
            for buckets, begin in zip(*_features(w), strict=True):
                total[begin + 1] += model[buckets]
            total = np.cumsum(total)
            out[w.rows.start : w.rows.stop] = total[w.first[1:]] - total[w.first[:-1]]
        batch = batch if keep else batch.drop_columns([column])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, "log_weight"])
