"""Near-duplicate embeddings by NN-descent.

1. Equal vectors become one node with a weight. Nodes start with the best of the
   vectors that share a random-hyperplane bucket; a bucket is dealt into blocks of
   bounded size, however many copies it holds.
2. Rounds: every node is sent to the nodes it lists and to those that list it. All who
   meet at a node, and the node itself, are neighbours or neighbours of a neighbour and
   are compared there, all against all of a block of bounded size; each keeps the best
   ones it meets. A list is saturated if its
   ``size`` entries are all over the threshold; it doubles until they are not.
   Each round also deals buckets of new hyperplanes, and all blocks by another hash.
3. Audit: of the nodes in enlarged components (see 4), of the others with a link and
   of those without, a bounded sample each is compared with all vectors, in blocks.
   Pairs count once, without copies, and only outside enlarged components, which are
   exact within. Another round follows while the links found are fewer than
   ``recall`` of the estimate, or the round has added more than the rest of that. If
   the last round ends so, all vectors are compared with all, in blocks.
4. Edges at the threshold, in double precision, give components. A saturated list may
   miss links that are no closer than those it has: it is enlarged to its whole
   component, without listing it. Members within half the threshold's angle of the
   component's centre are all linked with each other (angles obey the triangle
   inequality) and are only counted; the members further out are compared with all
   of the component, in blocks.

So a third of all rows may be near copies of one vector: that costs a count, not
its square. A null or zero vector, or one with null or non-finite components, links
with nothing and is its own component. Vectors link within their length, whatever it
is. Rows that repeat an id are rows of their own; a null id's component is that of its
links. Of equally near neighbours those with smaller numbers stay in a list. An empty
table gives an empty result; no other column is read, so none clashes. Nothing but the
audit's samples is collected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stationflow.llm.components import components
from stationflow.llm.staging import staged
from stationflow.operators.skew import one_per_key
from stationflow.session import mark, release

BLOCK, TABLES, AUDIT, MOST_ROUNDS, MOST_LIST = 256, 6, 1000, 10, 64
_GRAPH = "node long, ids array<long>, sims array<double>"


def near_links(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95, size: int = 10, recall: float = 0.98) -> DataFrame:
    """(id, n_links, component_id, kept) for every row. ``kept`` marks the smallest id of a component."""
    rows = vectors.select(F.col(id_col).alias("_id"), F.col(vector_col).cast("array<double>").alias("_v"))
    rows = staged(rows.mapInArrow(_units, f"_id {vectors.schema[id_col].dataType.simpleString()}, unit binary"), "units")
    nodes = rows.filter("unit IS NOT NULL").groupBy("unit").agg(F.min(F.xxhash64("unit", "_id")).alias("node"), F.min("_id").alias("least"), F.count("*").alias("weight"))
    nodes = staged(nodes.withColumn("dim", F.length("unit")), "nodes")
    found = [_linked(nodes.filter(F.col("dim") == d).drop("dim"), d // 8, threshold, size, recall) for d in sorted(r["dim"] for r in nodes.select("dim").distinct().collect())]
    links = reduce(DataFrame.unionByName, found) if found else nodes.select("node", F.lit(0).cast("long").alias("more"), F.col("node").alias("component"))
    least = one_per_key(nodes.select("node", "least").join(links.select("node", "component"), "node"), ["component"], F.min("least").alias("component_id"))
    each = nodes.select("unit", "node", "weight").join(links, "node").join(least, "component")
    out = rows.join(each.select("unit", (F.col("weight") - 1 + F.col("more")).alias("n_links"), "component_id"), "unit", "left")
    out = out.select("_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "_id").alias("component_id"))
    return out.select(F.col("_id").alias(id_col), "n_links", "component_id", F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each vector over its length, as bytes of doubles; null if it has no direction."""
    for batch in batches:
        out = []
        for v in batch["_v"]:
            x = v.values
            x = None if x is None or x.null_count or not len(x) else x.to_numpy(zero_copy_only=False)
            if x is None or not np.isfinite(x).all() or not x.any():
                out.append(None)
            else:
                x = x / np.abs(x).max()
                out.append((x / np.linalg.norm(x)).tobytes())
        yield pa.RecordBatch.from_arrays([batch["_id"], pa.array(out, pa.binary())], names=["_id", "unit"])


def _matrix(column: pa.Array, kind: type = np.float64) -> np.ndarray:
    return np.array([np.frombuffer(x, kind) for x in column.to_pylist()])


def _linked(nodes: DataFrame, dim: int, threshold: float, size: int, recall: float, buckets: int = MOST_ROUNDS) -> DataFrame:
    """(node, more, component): the weight of the nodes linked with each node, and its component.

    New buckets are dealt in the first ``buckets`` rounds; later ones live on the lists alone.
    """
    units = staged(nodes, "nodes-of-a-length")
    count, since = units.count(), mark()
    bits = max(0, math.ceil(math.log2(max(1, count / (BLOCK // 4)))))
    bits = min(bits, 30)
    graph, before = staged(_best(_first(units, dim, bits, size, 0), threshold, size), "graph"), 0
    for turn in range(1, MOST_ROUNDS + 1):
        if turn <= buckets:
            met = _met(graph, units, MOST_LIST // 4, turn).unionByName(_first(units, dim, bits, size, turn))
        else:
            met = _met(graph, units, MOST_LIST // 4, turn)
        graph = staged(_best(met.unionByName(graph), threshold, size), "graph")
        release(since, keep=[graph])  # the round before and its blocks
        edges = staged(_edges(graph, units, threshold), "edges")
        saturated = graph.filter(F.get("sims", F.lit(size - 1)) >= threshold).select("node")
        result = staged(_counted(edges, units, saturated, dim, threshold), "counted")
        found, missing = _audited(result, edges, units, threshold, turn)
        if found >= recall * (found + missing) and (turn > 1 and found - before <= (1 - recall) * found):
            return result.drop("dense")
        before = found
    edges = staged(edges.unionByName(_across(result, units, threshold)).distinct(), "edges")
    return staged(_counted(edges, units, saturated, dim, threshold), "counted").drop("dense")


def _first(units: DataFrame, dim: int, bits: int, size: int, turn: int) -> DataFrame:
    """The best of each block of vectors that share a bucket, for every table of hyperplanes."""
    planes = np.random.default_rng(5 + turn).standard_normal((TABLES, dim, bits))

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch["unit"])
            small = pa.array([row.tobytes() for row in x.astype(np.float32)], pa.binary())
            for t in range(TABLES):
                code = ((x @ planes[t] > 0) @ (1 << np.arange(bits))).astype(np.int64) if bits else np.zeros(len(x), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(code * TABLES + t), batch["node"], small], names=["code", "node", "unit"])

    return _blocks(units.select("node", "unit").mapInArrow(codes, "code long, node long, unit binary"), "code", size, turn)


def _blocks(rows: DataFrame, key: str, size: int, turn: int = 0) -> DataFrame:
    """(node, ids, sims): the best of the rows that share a key, in blocks of about BLOCK rows."""
    rows = staged(rows, "blocks")
    counts = one_per_key(rows, [key], F.count("*").alias("n")).filter("n > 1")
    dealt = rows.join(counts, key).withColumn("block", F.pmod(F.xxhash64("node", key, F.lit(turn)), F.ceil(F.col("n") / BLOCK)))

    def best(keys: tuple, table: pa.Table) -> pa.Table:
        node = table["node"].to_numpy()
        x = _matrix(table["unit"], np.float32)
        sims = x @ x.T
        sims[node[:, None] == node] = -2
        k = min(size, len(node) - 1)
        if not k:
            return pa.Table.from_pydict({"node": [], "ids": [], "sims": []}, schema=_LISTS)
        top = np.argpartition(-sims, k - 1, 1)[:, :k]
        return pa.Table.from_pydict({"node": node, "ids": list(node[top]), "sims": list(np.take_along_axis(sims, top, 1).astype(np.float64))}, schema=_LISTS)

    return dealt.select(key, "block", "node", "unit").groupBy(key, "block").applyInArrow(best, "node long, ids array<long>, sims array<double>")


_LISTS = pa.schema([("node", pa.int64()), ("ids", pa.list_(pa.int64())), ("sims", pa.list_(pa.float64()))])


def _met(graph: DataFrame, units: DataFrame, size: int, turn: int) -> DataFrame:
    """The nodes that a node lists, those that list it and itself, compared with each other at it."""
    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                small = [row.tobytes() for row in _matrix(batch["unit"]).astype(np.float32)]
                yield pa.RecordBatch.from_arrays([batch["target"], batch["node"], pa.array(small, pa.binary())], names=["target", "node", "unit"])

    listed = graph.select(F.col("node").alias("target"), F.explode(F.array_append("ids", F.col("node"))).alias("node"))
    # A node that lists another which lists it meets it at both, once.
    sent = listed.unionByName(listed.select(F.col("node").alias("target"), F.col("target").alias("node"))).distinct()
    sent = sent.join(units.select("node", "unit"), "node").select("target", "node", "unit")
    return _blocks(sent.mapInArrow(narrow, "target long, node long, unit binary"), "target", size, turn)


def _best(lists: DataFrame, threshold: float, size: int) -> DataFrame:
    """Each node's best neighbours; a saturated list keeps twice as many, up to MOST_LIST."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                best = {}
                for part in row["parts"]:
                    best.update(zip(part["ids"], part["sims"], strict=True))
                ranked = sorted(best.items(), key=lambda x: (-x[1], x[0]))
                k = size
                while k < min(MOST_LIST, len(ranked)) and ranked[k - 1][1] >= threshold:
                    k *= 2
                out.append({"node": row["node"], "ids": [x for x, _ in ranked[:k]], "sims": [s for _, s in ranked[:k]]})
            yield pa.RecordBatch.from_pylist(out, schema=_LISTS)

    parts = lists.groupBy("node").agg(F.collect_list(F.struct("ids", "sims")).alias("parts"))
    return parts.mapInArrow(merge, _GRAPH)


def _edges(graph: DataFrame, units: DataFrame, threshold: float) -> DataFrame:
    """(a, b) of the lists that link in double precision, each once."""
    near = graph.select("node", F.explode(F.arrays_zip("ids", "sims")).alias("x")).filter(F.col("x.sims") >= threshold - 1e-3)
    pairs = near.select(F.greatest("node", "x.ids").alias("a"), F.least("node", "x.ids").alias("b")).distinct()
    side = units.select("node", "unit")
    both = pairs.join(side.toDF("a", "ua"), "a").join(side.toDF("b", "ub"), "b").select("a", "b", "ua", "ub")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cosine = np.einsum("ij,ij->i", _matrix(batch["ua"]), _matrix(batch["ub"]))
                yield batch.select(["a", "b"]).filter(pa.array(cosine >= threshold))

    return both.mapInArrow(check, "a long, b long")


def _counted(edges: DataFrame, units: DataFrame, saturated: DataFrame, dim: int, threshold: float) -> DataFrame:
    """(node, more, component, dense) with the components of saturated lists, the dense ones, counted whole."""
    found = staged(components(edges), "components")
    dense = one_per_key(found.join(saturated, "node", "left_semi"), ["component"]).withColumn("dense", F.lit(True))
    every = staged(units.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")).join(dense, "component", "left"), "members")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sparse = every.filter("dense IS NULL")
    listed = both.join(sparse.select(F.col("node").alias("b"), "weight"), "b").groupBy("a").agg(F.sum("weight").alias("more"))
    sparse = sparse.select("node", "component").join(listed.withColumnRenamed("a", "node"), "node", "left").select("node", F.coalesce("more", F.lit(0)).cast("long").alias("more"), "component", F.lit(False).alias("dense"))
    whole = _whole(every.filter("dense").select("component", "node", "weight", "unit"), dim, threshold)
    return sparse.unionByName(whole.withColumn("dense", F.lit(True)))


def _whole(members: DataFrame, dim: int, threshold: float) -> DataFrame:
    """(node, more, component) of whole components, by angles to their centres."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch["component"], pa.array(list(_matrix(batch["unit"])), pa.list_(pa.float64()))], names=["component", "v"])

    sums = members.select("component", "unit").mapInArrow(spread, "component long, v array<double>")
    sums = one_per_key(sums, ["component"], *[F.sum(F.col("v")[i]).alias(f"v{i}") for i in range(dim)])
    centres = sums.select("component", F.array(*[f"v{i}" for i in range(dim)]).alias("centre"))
    half = math.acos(threshold) / 2

    def angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                centre = np.array(batch["centre"].to_pylist())
                cosine = np.einsum("ij,ij->i", _matrix(batch["unit"]), centre) / np.linalg.norm(centre, axis=1)
                inner = np.arccos(np.clip(cosine, -1, 1)) < half - 1e-7
                yield pa.RecordBatch.from_arrays([batch["component"], batch["node"], batch["weight"], batch["unit"], pa.array(inner)], names=["component", "node", "weight", "unit", "inner"])

    placed = members.join(centres, "component").mapInArrow(angles, "component long, node long, weight long, unit binary, inner boolean")
    placed = staged(placed, "placed")
    total = one_per_key(placed.filter("inner"), ["component"], F.sum("weight").alias("all"))
    counted = placed.filter("inner").join(total, "component").select("node", (F.col("all") - F.col("weight")).alias("more"))
    more = counted.unionByName(_outer(placed, threshold)).groupBy("node").agg(F.sum("more").alias("more"))
    return placed.select("node", "component").join(more, "node", "left").select("node", F.coalesce("more", F.lit(0)).cast("long").alias("more"), "component")


def _outer(placed: DataFrame, threshold: float) -> DataFrame:
    """(node, more): the links of the members far from the centre, on both ends, block against block."""
    sizes = one_per_key(placed, ["component", "inner"], F.count("*").alias("n"))
    block = F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / BLOCK))
    blocks = placed.join(sizes, ["component", "inner"]).groupBy("component", "inner", block.alias("block")).agg(F.collect_list(F.struct("node", "weight", "unit")).alias("rows"))
    blocks = staged(blocks, "component-blocks")
    outer = blocks.filter("NOT inner").select("component", F.col("rows").alias("outer"))
    pairs = outer.join(blocks.select("component", "inner", F.col("rows").alias("all")), "component")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                node, other = (np.array([x["node"] for x in row[side]]) for side in ("outer", "all"))
                weight, weights = (np.array([x["weight"] for x in row[side]]) for side in ("outer", "all"))
                x, y = (np.array([np.frombuffer(r["unit"]) for r in row[side]]) for side in ("outer", "all"))
                linked = (x @ y.T >= threshold) & (node[:, None] != other)
                yield pa.RecordBatch.from_pydict({"node": node, "more": linked @ weights})
                if row["inner"]:
                    yield pa.RecordBatch.from_pydict({"node": other, "more": linked.T @ weight})

    return pairs.select("inner", "outer", "all").mapInArrow(compare, "node long, more long")


def _across(result: DataFrame, units: DataFrame, threshold: float) -> DataFrame:
    """(a, b): the links outside dense components by comparing all with all, in blocks; one of each node with a dense component."""
    rows = units.select("node", "unit").join(result.select("node", F.when(F.col("dense"), F.col("component")).alias("whole")), "node")
    rows = staged(rows, "all-nodes")
    many = max(1, math.ceil(rows.count() / (4 * BLOCK)))
    blocks = staged(rows.groupBy(F.pmod(F.xxhash64("node"), F.lit(many)).alias("block")).agg(F.collect_list(F.struct("node", "whole", "unit")).alias("rows")), "all-blocks")
    pairs = blocks.toDF("block", "x").join(blocks.toDF("other", "y"), F.col("block") <= F.col("other")).select("x", "y")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                node, other = (np.array([x["node"] for x in row[side]]) for side in "xy")
                x, y = (np.array([np.frombuffer(r["unit"]) for r in row[side]]) for side in "xy")
                group, groups = (np.array([r["node"] if r["whole"] is None else r["whole"] for r in row[side]]) for side in "xy")
                i, j = np.nonzero((x @ y.T >= threshold) & (node[:, None] != other) & (group[:, None] != groups))
                if len(i):
                    _, one = np.unique(np.stack([group[i], groups[j]]), axis=1, return_index=True)
                    a, b = node[i[one]], other[j[one]]
                    yield pa.RecordBatch.from_pydict({"a": np.maximum(a, b), "b": np.minimum(a, b)})

    return pairs.mapInArrow(compare, "a long, b long")


def _audited(result: DataFrame, edges: DataFrame, units: DataFrame, threshold: float, turn: int) -> tuple[int, float]:
    """Links found outside dense components and an estimate of those missing, each from both ends."""
    ends = edges.select("a").unionByName(edges.select(F.col("b").alias("a")))
    degree = ends.groupBy(F.col("a").alias("node")).agg(F.count("*").alias("found"))
    rows = result.select("node", "component", "dense").join(degree, "node", "left")
    rows = rows.select("node", "component", F.when(F.col("dense"), 0).otherwise(F.coalesce("found", F.lit(0))).alias("found"), F.when(F.col("dense"), 0).when(F.col("found") > 0, 1).otherwise(2).alias("kind"))
    rows = staged(rows, "audit")
    sizes = {r["kind"]: (r["n"], r["found"]) for r in rows.groupBy("kind").agg(F.count("*").alias("n"), F.sum("found").alias("found")).collect()}
    samples = [rows.filter(F.col("kind") == kind).orderBy(F.xxhash64("node", F.lit(turn))).limit(AUDIT) for kind in sizes]
    if not samples:
        return 0, 0.0
    sample = reduce(DataFrame.unionByName, samples).join(units.select("node", "unit"), "node").toArrow()
    node, queries, kinds = sample["node"].to_numpy(), _matrix(sample["unit"]), sample["kind"].to_numpy()
    whole = np.where(kinds == 0, sample["component"].to_numpy(), 0)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(node), np.int64)
        for batch in batches:
            if batch.num_rows:
                linked = (queries @ _matrix(batch["unit"]).T >= threshold) & (node[:, None] != batch["node"].to_numpy())
                linked &= (kinds[:, None] != 0) | (whole[:, None] != batch["component"].to_numpy())
                total += linked.sum(1)
        yield pa.RecordBatch.from_pydict({"node": node, "n": total})

    true = units.select("node", "unit").join(result.select("node", "component"), "node").mapInArrow(compare, "node long, n long").groupBy("node").agg(F.sum("n").alias("n")).toArrow()
    true = dict(zip(true["node"].to_pylist(), true["n"].to_pylist(), strict=True))
    missed = np.array([true[x] for x in node.tolist()]) - sample["found"].to_numpy()
    missing = sum(max(0, missed[kinds == kind].sum()) * n / (kinds == kind).sum() for kind, (n, _) in sizes.items())
    return sum(found for _, found in sizes.values()), float(missing)
