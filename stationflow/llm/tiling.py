"""Benchmark decontamination by greedy string tiling.

A document holds a test item if tiles cover at least ``coverage`` of the item's
words. Tiles are matches of at least ``min_match`` words between item and document
that overlap in neither; the longest unmarked match is marked first, again and
again. The order of the tiles in the document does not matter, so an item whose
sentences were shuffled is found as well.

1. Karp-Rabin hashes of ``min_match`` words of the items and of every document are
   joined: items are indexed, documents stream past the index where they are read
   and are never shuffled.
2. Pairs whose shared seeds could reach the coverage are tiled; seeds that follow
   each other on a diagonal are the maximal matches to begin with.

Items are indexed in slices of at most ``SLICE_BYTES`` of text, so what the driver
holds and sends is bounded; more items make more slices, each with a pass over the
documents that is written before the next. A document whose words repeat so often that
its seeds pair up with an index more than ``PAIRS`` times is not paired: items that share
enough seeds with it are tiled by searching the longest common run of free words, again
and again, which takes memory in proportion to the words. Both ways give the same tiles.

Words are runs of non-blank bytes, A-Z in lower case. An item of fewer than
``min_match`` words is held where all of them stand in a row. Items without text or
words are not tested, and a null or empty document holds nothing. Of tiles of one
length the first in the item counts, then the first in the document. Rows are judged
one by one, so repeated rows of documents share their result and repeated items are
reported each. Texts of any length are read whole. Empty documents or items give an
empty report and leave documents as they are. Other columns stay in ``decontaminated``,
whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stationflow.llm.staging import staged, text_bytes
from stationflow.llm.tokens import Words, inside_documents, shingles, words

MIN_MATCH, COVERAGE, SLICE_BYTES, PAIRS = 5, 0.5, 32 << 20, 1 << 20
_BITS = 20


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", min_match: int = MIN_MATCH, coverage: float = COVERAGE) -> DataFrame:
    """(id, item, coverage, tiles) for every document and item it holds."""
    kinds = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), text_bytes(F.col(text_col)).alias("_bytes"))
    schema = f"_id {kinds[0]}, _item {kinds[1]}, coverage double, tiles array<struct<item_start:int,doc_start:int,words:int>>"
    found = []
    for index, more in _indexes(items, item_col, item_text, min_match):
        part = rows.mapInArrow(lambda batches, index=index: _report(batches, index, coverage), schema)
        found.append(staged(part, "held") if more else part)
    empty = docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, found, empty).select(F.col("_id").alias(id_col), F.col("_item").alias(item_col), "coverage", "tiles")


def decontaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", min_match: int = MIN_MATCH, coverage: float = COVERAGE) -> DataFrame:
    """``docs`` without the documents that hold an item."""
    schema, column = docs.schema, docs.columns.index(text_col)
    for index, more in _indexes(items, item_col, item_text, min_match):
        part = docs.mapInArrow(lambda batches, index=index: _clean(batches, index, coverage, column), schema)
        docs = staged(part, "clean") if more else part
    return docs


@dataclass
class Index:
    """The seeds of some items: sorted hashes, and where each one stands in which item."""

    ids: pa.Array
    lengths: np.ndarray
    k: int
    hashes: np.ndarray
    item: np.ndarray
    place: np.ndarray
    maybe: np.ndarray  # by the low bits of a hash
    words: np.ndarray  # hashes of all items' words, and where each item begins
    first: np.ndarray
    short: dict[int, tuple[np.ndarray, np.ndarray]]  # by length: sorted hashes of whole items under ``k`` words, and the items


def _indexes(items: DataFrame, item_col: str, item_text: str, k: int) -> Iterator[tuple[Index, bool]]:
    """The index of each slice of the items, and whether there are several."""
    items = items.select(F.col(item_col).alias("item"), F.col(item_text).cast("binary").alias("text")).filter("text IS NOT NULL")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-size // SLICE_BYTES)
    for part in range(n):
        table = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == part).toArrow()
        if table.num_rows:
            yield _index(table["item"].combine_chunks(), table["text"].combine_chunks(), k), n > 1


def _index(ids: pa.Array, texts: pa.Array, k: int) -> Index:
    hashes, item, place, lengths, every = [], [], [], [], []
    short: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for w in words(texts, lower=True):
        at = np.flatnonzero(inside_documents(w, k))
        doc = w.doc_of_word()[at]
        hashes.append(shingles(w.hashes, k)[at])
        item.append(w.rows.start + doc)
        place.append(at - w.first[doc])
        lengths.append(w.counts)
        every.append(w.hashes)
        for n in range(1, k):
            own = np.flatnonzero(w.counts == n)
            if len(own):
                short.setdefault(n, []).append((shingles(w.hashes, n)[w.first[own]], w.rows.start + own))
    hashes, item, place = np.concatenate(hashes), np.concatenate(item), np.concatenate(place)
    order = np.argsort(hashes, kind="stable")
    maybe = np.zeros(1 << _BITS, bool)
    maybe[_low(hashes)] = True
    lengths = np.concatenate(lengths)
    wholes = {}
    for n, parts in short.items():
        whole, which = (np.concatenate(x) for x in zip(*parts, strict=True))
        by = np.argsort(whole, kind="stable")
        wholes[n] = whole[by], which[by]
    return Index(ids, lengths, k, hashes[order], item[order], place[order], maybe, np.concatenate(every), np.append(0, np.cumsum(lengths)), wholes)


def _low(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64((1 << _BITS) - 1)).astype(np.int64)


def tiles(pairs: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Greedy tiling from the seeds (item place, document place) of ``k`` words: (item, document, words)."""
    diagonal = pairs[:, 1] - pairs[:, 0]
    order = np.lexsort((pairs[:, 0], diagonal))
    diagonal, begin = diagonal[order], pairs[order, 0]
    new = np.flatnonzero(np.diff(diagonal, prepend=diagonal[0] - 1).astype(bool) | (np.diff(begin, prepend=-2) != 1))
    runs = np.diff(np.append(new, len(begin))) + k - 1
    heap = [(-n, i, i + d) for n, i, d in zip(runs.tolist(), begin[new].tolist(), diagonal[new].tolist(), strict=True)]
    heapq.heapify(heap)
    item_marks, doc_marks, out = set(), set(), []
    while heap:
        n, i, d = heapq.heappop(heap)
        open_ = [i + x not in item_marks and d + x not in doc_marks for x in range(-n)]
        if all(open_):
            out.append((i, d, -n))
            item_marks.update(range(i, i - n))
            doc_marks.update(range(d, d - n))
            continue
        begin_ = None
        for x, free in enumerate([*open_, False]):
            if free and begin_ is None:
                begin_ = x
            elif not free and begin_ is not None:
                if x - begin_ >= k:
                    heapq.heappush(heap, (begin_ - x, i + begin_, d + begin_))
                begin_ = None
    return sorted(out)


def tiles_of_words(item: np.ndarray, doc: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """The same tiles from the words' hashes, whatever repeats in them: (item, document, words).

    The longest run of free words that both have is found by halving, as every shorter
    one is common too; all its places are tiled in order, then comes the next length.
    """
    free = np.ones(len(item), bool), np.ones(len(doc), bool)
    out, most = [], min(len(item), len(doc))
    while True:
        low, high = k - 1, most
        while low < high:
            n = (low + high + 1) // 2
            (_, a), (_, b) = (_free_runs(x, f, n) for x, f in zip((item, doc), free, strict=True))
            low, high = (n, high) if np.isin(a, b).any() else (low, n - 1)
        if low < k:
            return sorted(out)
        (at, a), (to, b) = (_free_runs(x, f, low) for x, f in zip((item, doc), free, strict=True))
        order = np.argsort(b, kind="stable")
        to, b = to[order], b[order]
        begins, ends = np.searchsorted(b, a), np.searchsorted(b, a, "right")
        tried: dict[int, int] = {}  # by hash: how far its places in the document are used up
        for i, begin, end in zip(at.tolist(), begins.tolist(), ends.tolist(), strict=True):
            if begin == end or not (free[0][i] and free[0][i + low - 1]):
                continue
            here = tried.get(begin, begin)
            while here < end and not (free[1][to[here]] and free[1][to[here] + low - 1]):
                here += 1
            tried[begin] = here
            if here < end:
                d = int(to[here])
                out.append((i, d, low))
                free[0][i : i + low] = free[1][d : d + low] = False
        most = low - 1


def _free_runs(hashes: np.ndarray, free: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of ``n`` free words begin, and their hashes."""
    taken = np.append(0, np.cumsum(~free))
    at = np.flatnonzero(taken[n:] == taken[:-n])
    return at, shingles(hashes, n)[at]


def _ranges(low: np.ndarray, times: np.ndarray) -> np.ndarray:
    return np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)


def _held(texts: pa.Array, index: Index, coverage: float) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
    """(row, item, tiles) of the items that the documents hold."""
    k = index.k
    for w in words(texts, lower=True):
        yield from _short(w, index)
        seeds = shingles(w.hashes, k)
        at = np.flatnonzero(index.maybe[_low(seeds)] & inside_documents(w, k))
        low, high = (np.searchsorted(index.hashes, seeds[at], side) for side in ("left", "right"))
        times = high - low
        doc = np.searchsorted(w.first, at, "right") - 1
        pairs = np.bincount(doc, times, len(w.rows))
        for d in np.flatnonzero(pairs > PAIRS).tolist():
            yield from _repetitive(w, d, np.unique(low[(doc == d) & (times > 0)]), index, coverage)
        some = (times > 0) & (pairs[doc] <= PAIRS)
        if not some.any():
            continue
        at, doc, low, times = at[some], doc[some], low[some], times[some]
        entry = _ranges(low, times)
        at, doc = np.repeat(at, times), np.repeat(doc, times)
        item, place = index.item[entry], index.place[entry]
        order = np.lexsort((place, item, doc))
        doc, item, place, at = doc[order], item[order], place[order], at[order]
        groups = np.flatnonzero(np.diff(doc, prepend=-1).astype(bool) | np.diff(item, prepend=-1).astype(bool))
        for a, b in zip(groups.tolist(), [*groups[1:].tolist(), len(doc)], strict=True):
            j = int(item[a])
            if not _may_reach(np.unique(place[a:b]), j, index, coverage):
                continue
            found = tiles(np.stack([place[a:b], at[a:b] - w.first[doc[a]]], 1), k)
            if sum(x[2] for x in found) >= coverage * index.lengths[j]:
                yield w.rows.start + int(doc[a]), j, found


def _may_reach(places: np.ndarray, item: int, index: Index, coverage: float) -> bool:
    """Whether seeds at these places of an item can cover enough of it."""
    return index.k + np.minimum(np.diff(places), index.k).sum() >= coverage * index.lengths[item]


def _repetitive(w: Words, d: int, low: np.ndarray, index: Index, coverage: float) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
    """The items that a document of much repeated words holds; ``low`` are its seeds' first entries."""
    entry = _ranges(low, np.searchsorted(index.hashes, index.hashes[low], "right") - low)
    item, place = index.item[entry], index.place[entry]
    order = np.lexsort((place, item))
    item, place = item[order], place[order]
    groups = np.flatnonzero(np.diff(item, prepend=-1))
    for a, b in zip(groups.tolist(), [*groups[1:].tolist(), len(item)], strict=True):
        j = int(item[a])
        if _may_reach(place[a:b], j, index, coverage):
            found = tiles_of_words(index.words[index.first[j] : index.first[j + 1]], w.hashes[w.first[d] : w.first[d + 1]], index.k)
            if sum(x[2] for x in found) >= coverage * index.lengths[j]:
                yield w.rows.start + d, j, found


def _short(w: Words, index: Index) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
    """The items under ``k`` words that documents hold in a row, each at its first place."""
    for n, (whole, which) in index.short.items():
        runs = shingles(w.hashes, n)
        at = np.flatnonzero(inside_documents(w, n))
        low, high = (np.searchsorted(whole, runs[at], side) for side in ("left", "right"))
        doc = np.searchsorted(w.first, at, "right") - 1
        _, first = np.unique(np.stack([doc, low], 1)[high > low], axis=0, return_index=True)
        hits = np.flatnonzero(high > low)[first]
        for x in hits.tolist():
            for j in which[low[x] : high[x]].tolist():
                yield w.rows.start + int(doc[x]), j, [(0, int(at[x] - w.first[doc[x]]), n)]


def _report(batches: Iterator[pa.RecordBatch], index: Index, coverage: float) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("item_start", pa.int32()), ("doc_start", pa.int32()), ("words", pa.int32())]))
    for batch in batches:
        found = list(_held(batch["_bytes"], index, coverage))
        shares = [float(sum(x[2] for x in t) / index.lengths[j]) for _, j, t in found]
        lists = [[dict(zip(("item_start", "doc_start", "words"), x, strict=True)) for x in t] for _, _, t in found]
        yield pa.RecordBatch.from_arrays(
            [
                batch["_id"].take(pa.array([r for r, _, _ in found], pa.int64())),
                index.ids.take(pa.array([j for _, j, _ in found], pa.int64())),
                pa.array(shares, pa.float64()),
                pa.array(lists, kind),
            ],
            names=["_id", "_item", "coverage", "tiles"],
        )


def _clean(batches: Iterator[pa.RecordBatch], index: Index, coverage: float, column: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = np.ones(batch.num_rows, bool)
        keep[[r for r, _, _ in _held(batch.column(column).cast(pa.binary()).fill_null(b""), index, coverage)]] = False
        yield batch.filter(pa.array(keep))
