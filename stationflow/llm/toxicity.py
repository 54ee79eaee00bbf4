"""Toxicity by a convolutional text classifier, trained in numpy.

A word's vector is the sum of hashed embeddings of the word and its first 3 to 6
bytes, so an inflected form shares the vector of its stem. Filters of one, two and
three words slide over the whole text, the maximum of each over the text is taken,
and a logistic layer gives the score. One bad sentence in a long text counts as
much as in a short one.

Training reads every labelled text that isn't held out, whole. They are dealt by a
hash of the id to parts of about ``PART_BYTES`` of text, a task each. Embeddings start
from the log-odds of the labels, counted over all of them. In each of ``ROUNDS`` rounds
every task trains filters and embeddings by mini-batches over its part, from the same
model and with a fixed seed, ``PASSES`` times over each slice of a few megabytes; the
next model is the mean of what the tasks have made of it, each part by its rows, each
bucket over the parts that changed it. A fifth of the labelled rows is kept from this to
calibrate, for each language, the threshold with the best F1 among multiples of
1 / ``BINS`` (languages with few labelled texts take the threshold of all), from counts
of all their scores. Languages never enter a score; ``score`` is the label's estimated
probability, as the classifier gives it. What reaches the driver doesn't follow the rows:
a model, and for each language a count for each bin.

Scoring reads every text whole where it lies, without a shuffle; the model's size is
fixed. A null or empty text has no words and gets the score of no evidence. A text
with several labels is toxic if one says so. Without labels of both kinds every
score is the share of toxic labels, 0 if there are none. Rows are scored one by one,
repeated ones alike, and texts of any length in blocks of words; rows that share an id
train each. An empty table gives an empty result. Columns but the id, the text and the
language, clashing or not, aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from copy import deepcopy
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stationflow.llm.staging import opened, squeezed, staged, text_bytes
from stationflow.llm.tokens import Words, mix, words

PART_BYTES, BINS = 64 << 20, 1 << 12
BUCKETS, SIZE, FILTERS, WIDTHS = 1 << 17, 8, 8, (1, 2, 3)
PREFIXES = (3, 4, 5, 6)
ROUNDS, PASSES, BATCH, RATE = 2, 3, 64, 0.01
_BLOCK = 1 << 16


@dataclass
class Model:
    embeddings: np.ndarray  # BUCKETS + 1 rows, the last one of zeros stands beyond a text's end
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    weights: np.ndarray
    bias: float
    thresholds: dict[str | None, float]


def toxicity(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, held_out, score, predicted, lang_threshold, flagged); rows with ``held_out`` train nothing."""
    docs = docs.select(F.col(id_col).alias("_id"), F.coalesce(held_out, F.lit(False)).alias("_held_out"), text_bytes(F.col(text_col)).alias("_bytes"), F.col(lang_col).cast("string").alias("_lang"))
    model = train(docs, labels, id_col)
    kind = docs.schema["_id"].dataType.simpleString()
    scored = docs.mapInArrow(lambda batches: _scores(batches, model), f"_id {kind}, held_out boolean, score double, lang_threshold double")
    return scored.select(F.col("_id").alias(id_col), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "lang_threshold", (F.col("score") >= F.col("lang_threshold")).alias("flagged"))


def train(docs: DataFrame, labels: DataFrame, id_col: str) -> Model:
    """The model of all labelled rows that aren't held out."""
    rows = _labelled(docs, labels, id_col)
    counts = {(r["spare"], r["toxic"]): r["n"] for r in rows.groupBy("spare", "toxic").agg(F.count("*").alias("n")).collect()}
    clean, toxic = (sum(n for (_, label), n in counts.items() if label == x) for x in (0, 1))
    if not clean or not toxic:
        return _model(40.0 if toxic else -40.0)
    used = rows
    if all(counts.get((False, x)) for x in (0, 1)):
        used, spare = rows.filter("NOT spare"), rows.filter("spare")
        clean, toxic = (counts[False, x] for x in (0, 1))
    else:
        spare = rows.limit(0)
    model = _model(float(np.log(toxic / clean)) - 1)
    random = np.random.default_rng(3)
    model.embeddings[:BUCKETS] = random.normal(0, 0.05, (BUCKETS, SIZE))
    model.embeddings[:BUCKETS, 0] = _log_odds(used, clean, toxic) / (1 + len(PREFIXES))
    for part, n in zip(model.filters, WIDTHS, strict=True):
        part[:] = random.normal(0, 0.1, part.shape)
        part[::SIZE, : FILTERS // 2] += 1 / n
    model.weights[:] = random.normal(0.3, 0.1, model.weights.shape)
    for turn in range(ROUNDS):
        model = _mean_of_parts(model, used, turn)
    _calibrate(model, spare)
    return model


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    """(spare, toxic, _lang, _bytes) of the rows to learn from, squeezed, in parts by their ids."""
    verdicts = labels.filter(F.col("toxic").isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = docs.filter(~F.col("_held_out") & F.col("_id").isNotNull())
    parts = max(1, -(-(rows.agg(F.sum(F.length("_bytes").cast("long"))).first()[0] or 0) // PART_BYTES))
    rows = squeezed(rows.select("_id", F.col("_bytes").alias("_text"), "_lang")).withColumnRenamed("_text", "_bytes")
    rows = rows.repartition(parts, "_id").join(verdicts.repartition(parts, "_id"), "_id")
    rows = rows.sortWithinPartitions(F.xxhash64("_id"), "_id", "_bytes", "_lang")
    return staged(rows.select((F.pmod(F.xxhash64(F.lit(5), "_id"), F.lit(5)) == 0).alias("spare"), "toxic", "_lang", "_bytes"), "labelled")


def _model(bias: float) -> Model:
    return Model(
        np.zeros((BUCKETS + 1, SIZE), np.float32),
        [np.zeros((n * SIZE, FILTERS), np.float32) for n in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        np.zeros(FILTERS * len(WIDTHS), np.float32),
        bias,
        {None: 0.5},
    )


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Buckets, beginnings and labels of a few megabytes of texts at a time."""
    for batch in opened(batches, "_bytes"):
        toxic = batch["toxic"].to_numpy()
        for w in words(batch["_bytes"], lower=True):
            yield *_laid_out(w), toxic[w.rows.start : w.rows.stop]


def _buckets(w: Words) -> np.ndarray:
    """For each word the buckets of the word and its beginnings; a beginning the word is too short for is left out."""
    padded = np.concatenate([w.data, np.zeros(8, np.uint8)])
    eights = np.ndarray(len(w.data) + 1, "<u8", padded, strides=(1,))
    begin, lengths = eights[w.starts], w.ends - w.starts
    out = [w.hashes]
    for n in PREFIXES:
        out.append(np.where(lengths > n, mix((begin & np.uint64((1 << 8 * n) - 1)) * np.uint64(16) + np.uint64(n)), np.uint64(0)))
    table = (np.stack(out, 1) & np.uint64(BUCKETS - 1)).astype(np.int64)
    table[:, 1:][lengths[:, None] <= np.array(PREFIXES)] = BUCKETS
    return table


def _laid_out(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words, each text followed by blanks so that no filter reaches the next, and where texts begin."""
    blanks = max(WIDTHS) - 1
    counts = np.maximum(w.counts, 1)
    first = np.concatenate([[0], np.cumsum(counts + blanks)])
    table = np.full((first[-1], 1 + len(PREFIXES)), BUCKETS, np.int64)
    doc = w.doc_of_word()
    table[first[doc] + np.arange(len(doc)) - w.first[doc]] = _buckets(w) if len(doc) else table[:0]
    return table, first


def _windows(x: np.ndarray, width: int) -> np.ndarray:
    n = len(x) - max(WIDTHS) + 1
    return np.concatenate([x[i : i + n] for i in range(width)], 1)


def _log_odds(rows: DataFrame, clean: int, toxic: int) -> np.ndarray:
    """How much more often a bucket occurs in toxic texts than in others; 0 if in fewer than three texts."""
    sums = rows.select("toxic", "_bytes").mapInArrow(_seen, "bucket long, clean long, toxic long").groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()
    seen = np.zeros((2, BUCKETS))
    seen[:, sums["bucket"].to_numpy()] = sums["clean"].to_numpy(), sums["toxic"].to_numpy()
    odds = np.log((seen[1] + 0.5) / (toxic + 1)) - np.log((seen[0] + 0.5) / (clean + 1))
    return np.where(seen.sum(0) >= 3, odds, 0)


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each bucket a task's texts that have it, by label."""
    seen = np.zeros((2, BUCKETS + 1), np.int64)
    for table, first, toxic in _slices(batches):
        text = np.repeat(np.arange(len(toxic)), np.diff(first))
        found = np.unique(text[:, None] * (BUCKETS + 1) + table)
        bucket, label = found % (BUCKETS + 1), toxic[found // (BUCKETS + 1)]
        for x in (0, 1):
            seen[x] += np.bincount(bucket[label == x], minlength=BUCKETS + 1)
    at = np.flatnonzero(seen[:, :BUCKETS].any(0))
    yield pa.RecordBatch.from_pydict({"bucket": at, "clean": seen[0, at], "toxic": seen[1, at]})


def _mean_of_parts(model: Model, rows: DataFrame, turn: int) -> Model:
    """The model after a round."""
    numbers = [f"d{i}" for i in range(SIZE)]
    changes = rows.select("toxic", "_bytes").mapInArrow(lambda batches: _changes(batches, model, turn), "place long, n long, " + ", ".join(f"{d} float" for d in numbers))
    sums = changes.groupBy("place").agg(*[(F.sum(F.col(d) * F.col("n")) / F.sum("n")).alias(d) for d in numbers]).toArrow()
    table = _flat(model)
    table[sums["place"].to_numpy()] += np.stack([sums[d].to_numpy() for d in numbers], 1).astype(np.float32)
    return _unflat(table, model.thresholds)


def _changes(batches: Iterator[pa.RecordBatch], model: Model, turn: int) -> Iterator[pa.RecordBatch]:
    """What training on a task's rows changes, in rows of ``SIZE`` numbers; ``n`` is the number of the texts."""
    descent, rows = _Descent(deepcopy(model), np.random.default_rng((3, turn))), 0
    for table, first, toxic in _slices(batches):
        rows += len(toxic)
        for _ in range(PASSES):
            descent.over(table, first, toxic)
    if rows:
        change = _flat(descent.model) - _flat(model)
        at = np.flatnonzero(change.any(1) | (np.arange(len(change)) > BUCKETS))
        yield pa.RecordBatch.from_pydict({"place": at, "n": np.full(len(at), rows), **{f"d{i}": change[at, i] for i in range(SIZE)}})


def _flat(model: Model) -> np.ndarray:
    """All numbers of a model, the embeddings first, in rows of ``SIZE``."""
    rest = np.concatenate([*(x.reshape(-1) for x in model.filters), *model.biases, model.weights, np.float32([model.bias])])
    return np.concatenate([model.embeddings, np.pad(rest, (0, -len(rest) % SIZE)).reshape(-1, SIZE)])


def _unflat(table: np.ndarray, thresholds: dict[str | None, float]) -> Model:
    rest, at, parts = table[BUCKETS + 1 :].reshape(-1), 0, []
    for shape in [*((n * SIZE, FILTERS) for n in WIDTHS), *((FILTERS,) for _ in WIDTHS), (FILTERS * len(WIDTHS),)]:
        size = int(np.prod(shape))
        parts.append(rest[at : at + size].reshape(shape).copy())
        at += size
    return Model(table[: BUCKETS + 1].copy(), parts[: len(WIDTHS)], parts[len(WIDTHS) : -1], parts[-1], float(rest[at]), thresholds)


class _Descent:
    """Mini-batches: Adam for filters and weights, Adagrad for the embeddings that won a maximum."""

    def __init__(self, model: Model, random: np.random.Generator) -> None:
        self.model, self.random, self.step = model, random, 0
        self.moments: dict[tuple, list] = {}
        self.squares = np.full((BUCKETS + 1, 1), 1e-4, np.float32)

    def over(self, table: np.ndarray, first: np.ndarray, toxic: np.ndarray) -> None:
        """Once over the texts of a slice, in a new order."""
        order = self.random.permutation(len(toxic))
        for begin in range(0, len(order), BATCH):
            chosen = order[begin : begin + BATCH]
            sizes = first[chosen + 1] - first[chosen]
            self._batch(np.concatenate([table[first[i] : first[i + 1]] for i in chosen]), np.append(0, np.cumsum(sizes)), toxic[chosen])

    def _adam(self, name: tuple, value: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        mean, square = self.moments.setdefault(name, [np.zeros_like(value), np.zeros_like(value)])
        mean += 0.1 * (gradient - mean)
        square += 0.001 * (gradient * gradient - square)
        return value - RATE * (mean / (1 - 0.9**self.step)) / (np.sqrt(square / (1 - 0.999**self.step)) + 1e-8)

    def _batch(self, table: np.ndarray, first: np.ndarray, toxic: np.ndarray) -> None:
        model = self.model
        self.step += 1
        best, won = _winners(model, table, first)
        p = np.maximum(best + np.concatenate(model.biases), 0)
        error = (1 / (1 + np.exp(-(p @ model.weights + model.bias))) - toxic).astype(np.float32) / len(toxic)
        back = (error[:, None] * model.weights) * (p > 0)
        new_weights = self._adam(("w",), model.weights, p.T @ error + 1e-4 * model.weights)
        model.bias = float(self._adam(("b",), np.array([model.bias]), np.array([error.sum()]))[0])
        rows, changes = [], []
        for k, n in enumerate(WIDTHS):
            own = back[:, k * FILTERS : (k + 1) * FILTERS]
            buckets = table[won[:, k * FILTERS : (k + 1) * FILTERS, None] + np.arange(n)]
            inputs = model.embeddings[buckets].sum(3).reshape(*own.shape, n * SIZE)
            slope = own[:, :, None] * model.filters[k].T[None]
            rows.append(buckets.reshape(-1))
            changes.append(np.repeat(slope.reshape(-1, SIZE), 1 + len(PREFIXES), 0))
            model.filters[k] = self._adam(("f", k), model.filters[k], np.einsum("df,dfs->sf", own, inputs) + 1e-4 * model.filters[k])
            model.biases[k] = self._adam(("c", k), model.biases[k], own.sum(0))
        self._embeddings(np.concatenate(rows), np.concatenate(changes))
        model.weights = new_weights

    def _embeddings(self, rows: np.ndarray, changes: np.ndarray) -> None:
        order = np.argsort(rows, kind="stable")
        rows, changes = rows[order], changes[order]
        new = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        rows = rows[new]
        self.squares[rows] += np.add.reduceat((changes * changes).sum(1, keepdims=True), new, 0)
        self.model.embeddings[rows] -= 0.05 * np.add.reduceat(changes, new, 0) / np.sqrt(self.squares[rows])
        self.model.embeddings[BUCKETS] = 0


def _winners(model: Model, table: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text and filter the greatest response, without the bias, and the place of its window; a block of words at a time."""
    texts, blanks = len(first) - 1, max(WIDTHS) - 1
    best = np.full((texts, FILTERS * len(WIDTHS)), -np.inf, np.float32)
    won = np.zeros(best.shape, np.int64)
    every = np.arange(best.shape[1])
    for at in range(0, len(table), _BLOCK):
        to = min(at + _BLOCK, len(table) - blanks)
        if at >= to:
            break
        x = model.embeddings[table[at : to + blanks]].sum(1)
        response = np.concatenate([_windows(x, n) @ part for n, part in zip(WIDTHS, model.filters, strict=True)], 1)
        for i in range(np.searchsorted(first, at, "right") - 1, np.searchsorted(first, to)):
            a, b = max(first[i], at), min(first[i + 1] - blanks, to)
            if a < b:
                place = response[a - at : b - at].argmax(0)
                value = response[a - at + place, every]
                better = value > best[i]
                best[i], won[i] = np.where(better, value, best[i]), np.where(better, a + place, won[i])
    return best, won


def _calibrate(model: Model, spare: DataFrame) -> None:
    """The threshold of best F1 over all spare texts, and over each language with at least ten of both kinds."""
    binned = spare.select("toxic", "_lang", "_bytes").mapInArrow(lambda batches: _bins(batches, model), "lang string, bin int, toxic long")
    binned = staged(binned.groupBy("lang", "bin").agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")), "scores")
    model.thresholds[None] = _best_threshold(binned.groupBy("bin").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")).toPandas())
    both = binned.groupBy("lang").agg(F.sum("toxic").alias("a"), F.sum(F.col("n") - F.col("toxic")).alias("b")).filter("lang <> '' AND a >= 10 AND b >= 10").select("lang")
    for lang, own in binned.join(both, "lang").toPandas().groupby("lang"):
        model.thresholds[lang] = _best_threshold(own)


def _bins(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in opened(batches, "_bytes"):
        place = np.minimum(scored(model, batch["_bytes"]) * BINS, BINS - 1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch["_lang"], pa.array(place), batch["toxic"].cast(pa.int64())], names=["lang", "bin", "toxic"])


def _best_threshold(counts: pd.DataFrame) -> float:
    """The multiple of 1 / ``BINS`` where F1 is best; the one nearest to a half of equally good ones."""
    n, toxic = np.zeros((2, BINS))
    n[counts["bin"]], toxic[counts["bin"]] = counts["n"], counts["toxic"]
    hits, flagged = toxic[::-1].cumsum()[::-1], n[::-1].cumsum()[::-1]
    f1 = 2 * hits / np.maximum(flagged + hits[0], 1)
    best = np.flatnonzero(f1 == f1.max()) / BINS
    return float(best[np.argmin(np.abs(best - 0.5))])


def scored(model: Model, texts: pa.Array) -> np.ndarray:
    """The score of every text."""
    out = np.zeros(len(texts))
    for w in words(texts, lower=True):
        table, first = _laid_out(w)
        best = np.full((len(w.rows), FILTERS * len(WIDTHS)), -np.inf, np.float32)
        doc = np.repeat(np.arange(len(w.rows)), np.diff(first))
        blanks = max(WIDTHS) - 1
        inside = np.arange(len(table)) < (first[1:] - blanks)[doc]
        for at in range(0, len(table), _BLOCK):
            to = min(at + _BLOCK, len(table) - blanks)
            if at >= to:
                break
            x = model.embeddings[table[at : to + blanks]].sum(1)
            response = np.concatenate([_windows(x, n) @ part + bias for n, part, bias in zip(WIDTHS, model.filters, model.biases, strict=True)], 1)
            response[~inside[at:to]] = -np.inf
            new = np.flatnonzero(np.diff(doc[at:to], prepend=-1))
            np.maximum.at(best, doc[at:to][new], np.maximum.reduceat(response, new, 0))
        logit = np.maximum(best, 0) @ model.weights + model.bias
        out[w.rows.start : w.rows.stop] = 1 / (1 + np.exp(-np.clip(logit, -60, 60).astype(np.float64)))
    return out


def _scores(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        usual = model.thresholds[None]
        limits = [model.thresholds.get(x, usual) for x in batch["_lang"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["_id"], batch["_held_out"], pa.array(scored(model, batch["_bytes"])), pa.array(limits, pa.float64())], names=["_id", "held_out", "score", "lang_threshold"])
