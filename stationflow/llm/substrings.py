"""Removal of passages that occur more than once: seed and extend.

A passage is ``length`` consecutive words. Every window of that many words picks
the smallest hash among its runs of ``seed_words`` words (winnowing), so two equal
windows pick the same seed at the same place.

1. Seeds: documents are joined on their winnowed seeds; one that occurs once in
   the corpus can't lie in a repeat and ends there.
2. Extension: an occurrence of a shared seed is extended to every window that picked
   it, so many words to the left and the rest to the right. Occurrences are not paired
   and not extended word by word: those that agree over a whole extension form one
   class, counted by the window's 64-bit hash, so a passage with a million copies costs
   a million rows, not their square.
3. Overlapping repeated windows are merged; the runs are the maximal repeats of at
   least ``length`` words, and their words go.

Counts are combined before each shuffle and the joins back are on unique keys, so
adaptive execution can split a passage that a third of all rows share. Nothing is
capped. A null or empty text has no words and ``kept`` is ''; a text shorter than
``length`` words loses nothing; a text of any length is read whole. All copies of a
passage go, so there are no ties between them; repeated rows remove each other's
passages. Rows that repeat an id are told apart by their text (``staging.keyed``). An
empty table gives an empty result. Other columns of the input, clashing or not, are
left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stationflow.llm.staging import keyed, opened, squeezed
from stationflow.llm.tokens import Words, inside_documents, shingles, words
from stationflow.operators.skew import one_per_key

_KEPT = "_id {id}, n_words long, spans array<struct<start:int,end:int>>, n_removed long, kept binary"


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 35, seed_words: int = 12) -> DataFrame:
    """(id, n_words, spans, n_removed, kept): each document without its repeated passages.

    ``spans`` are the maximal repeats as half-open ranges of words; ``kept`` is the
    remaining words joined by single blanks.
    """
    if not 0 < seed_words <= length:
        raise ValueError("seed_words must be between 1 and length")
    rows = keyed(docs, id_col, text_col)
    seeds = rows.select("_key", "_text").mapInArrow(lambda batches: _seeds(batches, length, seed_words), "seed long, _key long, place int")
    shared = _repeated(seeds, "seed")
    places = seeds.join(shared, "seed").groupBy("_key").agg(F.collect_list("place").alias("places"))
    texts = squeezed(rows)  # both joins are left ones, so one exchange of the texts serves them
    windows = texts.join(places, "_key", "left").select("_id", "_key", "_text", "places")
    windows = windows.mapInArrow(lambda batches: _windows(batches, length, seed_words), "window long, _key long, start int")
    starts = windows.join(_repeated(windows, "window"), "window").groupBy("_key").agg(F.collect_list("start").alias("starts"))
    marked = texts.join(starts, "_key", "left").select("_id", "_key", "_text", "starts")
    kind = docs.schema[id_col].dataType.simpleString()
    kept = marked.mapInArrow(lambda batches: _cut(batches, length), _KEPT.format(id=kind))
    return kept.select(F.col("_id").alias(id_col), "n_words", "spans", "n_removed", F.col("kept").cast("string").alias("kept"))


def _repeated(rows: DataFrame, key: str) -> DataFrame:
    return one_per_key(rows, [key], F.count("*").alias("n")).filter("n > 1").select(key)


def _picked(w: Words, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the runs of ``k`` words; the run that each window picks; which windows lie in one text."""
    runs = shingles(w.hashes, k)
    whole = inside_documents(w, length)
    return runs, _rightmost_least(runs, length - k + 1) if len(whole) else np.zeros(0, np.int64), whole


def _rightmost_least(values: np.ndarray, size: int) -> np.ndarray:
    """Where the least of each ``size`` neighbouring values stands, the last of equal ones."""
    n = len(values) - size + 1
    where = np.arange(len(values))
    span = 1
    while span * 2 <= size:
        right = values[span:] <= values[:-span]
        where = np.where(right, where[span:], where[:-span])
        values = np.where(right, values[span:], values[:-span])
        span *= 2
    other = slice(size - span, size - span + n)
    return np.where(values[other] <= values[:n], where[other], where[:n])


def _seeds(batches: Iterator[pa.RecordBatch], length: int, k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = batch["_key"].to_numpy(zero_copy_only=False)
        for w in words(batch["_text"]):
            runs, picked, whole = _picked(w, length, k)
            at = picked[whole]
            at = at[np.flatnonzero(np.diff(at, prepend=-1))]
            yield _rows(w, keys, ("seed", runs[at]), "place", at)


def _rows(w: Words, keys: np.ndarray, hashed: tuple[str, np.ndarray], name: str, at: np.ndarray) -> pa.RecordBatch:
    doc = np.searchsorted(w.first, at, "right") - 1
    return pa.RecordBatch.from_pydict({hashed[0]: hashed[1].view(np.int64), "_key": keys[w.rows.start + doc], name: (at - w.first[doc]).astype(np.int32)})


def _listed(batch: pa.RecordBatch, column: str, w: Words) -> np.ndarray:
    """Places in the slice that a column of lists of places in each text names."""
    lists = batch[column].slice(w.rows.start, len(w.rows))
    counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return lists.flatten().to_numpy(zero_copy_only=False) + np.repeat(w.first[:-1], counts)


def _windows(batches: Iterator[pa.RecordBatch], length: int, k: int) -> Iterator[pa.RecordBatch]:
    for batch in opened(batches, "_text"):
        keys = batch["_key"].to_numpy(zero_copy_only=False)
        for w in words(batch["_text"]):
            _, picked, whole = _picked(w, length, k)
            seed = np.zeros(len(w.starts) + 1, bool)
            seed[_listed(batch, "places", w)] = True
            at = np.flatnonzero(whole & seed[picked]) if len(whole) else np.zeros(0, np.int64)
            yield _rows(w, keys, ("window", shingles(w.hashes, length)[at]), "start", at)


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in opened(batches, "_text"):
        texts = batch["_text"]
        for w in words(texts, hashed=False):
            begins = np.zeros(len(w.starts) + 1, np.int32)
            begins[_listed(batch, "starts", w)] = 1
            open_ = np.cumsum(begins)
            open_[length:] -= open_[:-length].copy() if len(open_) > length else 0
            gone = open_[:-1] > 0
            before = np.concatenate([[0], np.cumsum(gone)])
            removed = before[w.first[1:]] - before[w.first[:-1]]
            kept, spans = [], []
            for d, row in enumerate(w.rows):
                own = texts[row].as_py().split()
                if removed[d]:
                    mask = gone[w.first[d] : w.first[d + 1]]
                    edges = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0)).tolist()
                    spans.append([{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2], strict=True)])
                    own = compress(own, (~mask).tolist())
                else:
                    spans.append([])
                kept.append(b" ".join(own))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["_id"].slice(w.rows.start, len(w.rows)),
                    pa.array(w.counts, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()),
                ],
                names=["_id", "n_words", "spans", "n_removed", "kept"],
            )
