"""Near-duplicate documents: n-gram Jaccard join with adaptive multi-match prefixes.

A document's set is its distinct shingles of ``n`` words (fewer words: the whole
sequence as one; none: the empty set, linked with nothing). Two documents link when
their sets' intersection is at least ``share`` hundredths of the union.

1. Documents with equal sets are one node; copies are never paired.
2. A fixed-size sketch counts all shingles of the corpus, and every set is put in
   order from rare to frequent by it. Linked sets share a token among the first
   |x| - share*|x| + 1 of each, or ``m`` tokens among ``m - 1`` more. Each document
   takes the ``m`` that costs least: the length of the lists its prefix meets, plus
   the candidates it expects, at most those lists divided by ``m``.
3. Stars: the documents of a token's list are candidates of one of them, the one with
   the fewest rarer tokens, which tends to be the centre of a group of near copies.
   Candidates that share enough prefix tokens are verified on their whole texts.
4. What the stars leave open: documents of one list that are not yet connected are
   candidates of each other if a token stands early enough in both to be the first
   they share, and if they share enough prefix tokens. Only pairs across components remain, so a group of near
   copies is not expanded into its pairs, and no link between components is lost.

Lists are joins and counts on tokens, combined before shuffles; a token that a
third of all documents share stands at the end of every order. Nothing is capped.
Rows that repeat an id are told apart by their text; a null text is empty. Texts of any
length are read whole. Of equal choices the smallest hash, and of a component the
smallest id counts. An empty table gives an empty result. ``near_duplicates`` reads the
id and the text only; ``one_of_each`` returns all columns, whatever their names. Equal
sets are known by one 64-bit hash. Links between different texts of one component are
not listed: the result is components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stationflow.llm.components import components
from stationflow.llm.staging import keyed, opened, squeezed, staged, unique_ids
from stationflow.llm.tokens import Words, inside_documents, mix, shingles, words
from stationflow.operators.skew import one_per_key

SKETCH = 1 << 18
#: Most extra prefix tokens tried, and the cost of verifying a candidate in list entries.
MOST_MATCHES, VERIFY = 4, 16
_SALT = np.uint64(0xA0761D6478BD642F)
_POSTING = "token long, node long, size int, place int, matches int"


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, share: int = 80) -> DataFrame:
    """(id, n_shingles, component_id): the smallest id that each row reaches by links, itself included."""
    if not 50 <= share <= 100:
        raise ValueError("share must be between 50 and 100 hundredths")
    rows = keyed(docs, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    sets = staged(rows.mapInArrow(lambda batches: _sets(batches, n), f"_id {kind}, _key long, n_shingles long, node long"), "sets")
    sketch = _sketch(rows, n)
    postings = rows.select("_text").mapInArrow(lambda batches: _postings(batches, n, share, sketch), _POSTING)
    shared = one_per_key(postings, ["token"], F.count("*").alias("n")).filter("n > 1").select("token")
    lists = staged(postings.join(shared, "token").distinct(), "lists")
    keys = staged(sets.filter("node IS NOT NULL").groupBy("node").agg(F.min("_key").alias("_key")), "keys")
    texts = squeezed(rows.select("_key", "_text"))
    first = staged(_verified(_stars(lists, share), keys, texts, n, share), "stars")
    nodes = components(first.filter("linked").select("a", "b"))
    second = staged(_open_pairs(lists, staged(nodes, "nodes"), share).join(first.select("a", "b"), ["a", "b"], "left_anti"), "open")
    links = first
    if not second.isEmpty():
        links = links.unionByName(staged(_verified(second, keys, texts, n, share), "links"))
        nodes = components(links.filter("linked").select("a", "b"))
    members = sets.join(nodes.withColumnRenamed("component", "_group"), "node", "left")
    members = members.withColumn("_group", F.coalesce("_group", "node"))
    least = one_per_key(members.filter("_group IS NOT NULL"), ["_group"], F.min("_id").alias("component_id"))
    out = members.join(least, "_group", "left")
    return out.select(F.col("_id").alias(id_col), "n_shingles", F.coalesce("component_id", "_id").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, share: int = 80) -> DataFrame:
    """``docs`` with the smallest id of each component only; rows without words stay."""
    found = near_duplicates(docs, id_col, text_col, n, share)
    kept = found.filter(F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col(id_col).alias("_kept")).distinct()
    out = docs.join(kept, F.col(id_col).eqNullSafe(F.col("_kept")), "left_semi")
    return out if unique_ids(docs, id_col) else out.dropDuplicates([id_col, text_col])


def _shingles(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of a slice, and the document of each."""
    at = np.flatnonzero(inside_documents(w, n))
    doc = w.doc_of_word()
    hashes, doc = shingles(w.hashes, n)[at], doc[at]
    few = np.flatnonzero((w.counts > 0) & (w.counts < n))
    if len(few):
        whole = [int(shingles(w.hashes[w.first[d] : w.first[d + 1]], int(w.counts[d]))[0]) for d in few.tolist()]
        hashes, doc = np.concatenate([hashes, np.array(whole, np.uint64)]), np.concatenate([doc, few])
        order = np.argsort(doc, kind="stable")
        hashes, doc = hashes[order], doc[order]
    return hashes, doc


def _each(batch: pa.RecordBatch, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingles) of the batch's documents that have any."""
    for w in words(batch["_text"], lower=True):
        hashes, doc = _shingles(w, n)
        first = np.searchsorted(doc, np.arange(len(w.rows) + 1))
        for d in np.flatnonzero(np.diff(first)).tolist():
            yield w.rows.start + d, _distinct(hashes[first[d] : first[d + 1]])


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])]


def _node(tokens: np.ndarray) -> int:
    """The number of a set: equal for equal sets."""
    total = np.add.reduce(mix(tokens ^ _SALT), keepdims=True) * _SALT + np.uint64(len(tokens))
    return int(mix(total).view(np.int64)[0])


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, nodes = [0] * batch.num_rows, [None] * batch.num_rows
        for row, tokens in _each(batch, n):
            sizes[row], nodes[row] = len(tokens), _node(tokens)
        yield pa.RecordBatch.from_arrays([batch["_id"], batch["_key"], pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64())], names=["_id", "_key", "n_shingles", "node"])


def _sketch(rows: DataFrame, n: int) -> np.ndarray:
    """Counts of all shingles by the low bits of their hash: SKETCH numbers, whatever the corpus."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH, np.int64)
        for batch in batches:
            for w in words(batch["_text"], lower=True):
                total += np.bincount(_low(_shingles(w, n)[0]), minlength=SKETCH)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": used.astype(np.int32), "n": total[used]})

    counts = rows.select("_text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(SKETCH, np.int64)
    out[counts["bucket"].to_numpy()] = counts["n"].to_numpy()
    return out


def _low(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(SKETCH - 1)).astype(np.int64)


def _prefix(size: int, share: int) -> int:
    """Tokens of which a linked set of any size shares one."""
    return size - -(-share * size // 100) + 1


def _matches(lists: np.ndarray, base: int) -> int:
    """How many shared tokens to ask for: the cheapest prefix by its lists and expected candidates."""
    total = np.cumsum(lists)
    tried = np.arange(1, min(MOST_MATCHES, len(lists) - base + 1) + 1)
    cost = total[base - 2 + tried] * (1 + VERIFY / tried)
    return int(tried[np.argmin(cost)])


def _postings(batches: Iterator[pa.RecordBatch], n: int, share: int, sketch: np.ndarray) -> Iterator[pa.RecordBatch]:
    noise = sketch.sum() / SKETCH
    for batch in batches:
        tokens, meta = [], []
        for _, own in _each(batch, n):
            size, counts = len(own), sketch[_low(own)]
            base = _prefix(size, share)
            most = min(size, base + MOST_MATCHES - 1)
            if most < size:
                near = np.argpartition(counts, most - 1)
                cut = counts[near[most - 1]]
                near = np.flatnonzero(counts <= cut)
            else:
                near = np.arange(size)
            near = near[np.lexsort((own[near], counts[near]))][:most]
            lists = np.maximum(counts[near] - noise, 1)
            m = _matches(lists, base)
            used = base + m - 1
            tokens.append(own[near[:used]])
            meta.append((_node(own), size, used, m))
        if tokens:
            table = np.array(meta, np.int64)
            used = table[:, 2]
            place = np.arange(used.sum()) - np.repeat(np.cumsum(used) - used, used)
            node, size, _, m = np.repeat(table, used, 0).T
            yield pa.RecordBatch.from_pydict({"token": np.concatenate(tokens).view(np.int64), "node": node, "size": size.astype(np.int32), "place": place.astype(np.int32), "matches": m.astype(np.int32)})


def _possible(share: int, matches: str) -> str:
    """Sizes and places that leave room for a link, if this is one of the first ``matches`` tokens that x and y share."""
    # a link needs (100 + share) * intersection >= share * (|x| + |y|)
    return f"100 * least(x.size, y.size) >= {share} * greatest(x.size, y.size) AND (100 + {share}) * (least(x.size - x.place, y.size - y.place) + {matches} - 1) >= {share} * (x.size + y.size)"


def _stars(lists: DataFrame, share: int) -> DataFrame:
    """Candidates (a, b): each list's documents with its centre, if they share enough tokens of such lists."""
    centre = one_per_key(lists, ["token"], F.min(F.struct("place", "size", "node", "matches")).alias("c")).select("token", "c.*")
    pairs = lists.alias("x").join(centre.alias("y"), "token").where(f"x.node <> y.node AND {_possible(share, 'least(x.matches, y.matches)')}")
    ends = pairs.select(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b"), F.least("x.matches", "y.matches").alias("m"))
    return ends.groupBy("a", "b").agg(F.count("*").alias("n"), F.min("m").alias("m")).filter("n >= m").select("a", "b")


def _open_pairs(lists: DataFrame, nodes: DataFrame, share: int) -> DataFrame:
    """Candidates (a, b) of different components.

    The first token that two linked sets share stands early in both. Pairs that have
    such a token are found first; only for them all shared tokens are counted.
    """
    marked = lists.join(nodes, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = one_per_key(marked, ["token"], F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("token")
    open_ = staged(marked.join(mixed, "token", "left_semi"), "mixed")
    early = open_.filter(f"100 * (size - place) >= {share} * size")
    pairs = early.alias("x").join(early.alias("y"), "token").where(f"x.component <> y.component AND x.node > y.node AND {_possible(share, '1')}")
    pairs = pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    prefixes = one_per_key(lists, ["node"], F.collect_list("token").alias("tokens"), F.first("matches").alias("matches"))
    both = pairs.join(prefixes.toDF("a", "ta", "ma"), "a").join(prefixes.toDF("b", "tb", "mb"), "b")
    return both.filter("size(array_intersect(ta, tb)) >= least(ma, mb)").select("a", "b")


def _verified(pairs: DataFrame, keys: DataFrame, texts: DataFrame, n: int, share: int) -> DataFrame:
    """(a, b, linked) by the whole texts of both, whose one exchange serves both joins."""
    named = pairs.join(keys.toDF("a", "ka"), "a").join(keys.toDF("b", "kb"), "b")
    left = named.join(texts.toDF("ka", "ta"), "ka")
    both = left.join(texts.toDF("kb", "tb"), "kb").select("a", "b", "ta", "tb")
    return both.mapInArrow(lambda batches: _linked(batches, n, share), "a long, b long, linked boolean")


def _linked(batches: Iterator[pa.RecordBatch], n: int, share: int) -> Iterator[pa.RecordBatch]:
    last, kept = None, None
    for batch in opened(batches, "ta", "tb"):
        out = np.zeros(batch.num_rows, bool)
        mine = dict(_each(batch.select(["ta"]).rename_columns(["_text"]), n))
        other = batch["b"].to_pylist()
        for row in range(batch.num_rows):
            if other[row] != last:
                last = other[row]
                kept = next(_each(batch.slice(row, 1).select(["tb"]).rename_columns(["_text"]), n))[1]
            both = len(np.intersect1d(mine[row], kept, assume_unique=True))
            out[row] = 100 * both >= share * (len(mine[row]) + len(kept) - both)
        yield pa.RecordBatch.from_arrays([batch["a"], batch["b"], pa.array(out)], names=["a", "b", "linked"])
