"""Archives, packing and embeddings: round trips and brute force."""

import gzip
import hashlib
import os
import zlib
from collections import Counter

import numpy as np
import plain
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import public_tokenizers
from stationflow.llm import neighbours, packing, warc
from stationflow.llm.queries import QUERIES
from stationflow.llm.staging import new_folder

TOKENS = public_tokenizers.path("byte_bpe_50k.json")


def test_loser_tree(rng):
    for _ in range(300):
        runs = [sorted((rng.randrange(9),) for _ in range(rng.randrange(6))) for _ in range(rng.randrange(9))]
        assert [(runs[r][p], r) for r, p in warc.loser_tree(runs)] == sorted((x, i) for i, run in enumerate(runs) for x in run)


def test_url_keys():
    assert warc.url_key("https://www.Ex.example.org:80/a/B?q=1#f") == "org,example,ex)/a/b?q=1"
    assert warc.url_key("http://h.example") == "example,h)/" and warc.url_key("") == "" and warc.url_key("http://[bad") == "http://[bad"


@pytest.fixture
def pages(spark):
    big = "x" * 1500
    rows = [
        (1, "http://b.example/1", big), (2, "http://a.example/2", big), (3, "http://a.example/2", big), (4, None, None),
        (5, "http://a.example/\n5 é", ""), (6, "u", "short"), (7, "u", "short"), (8, "v", "é\r\n\r\nWARC/1.1\r\n\x00" * 4000),
        (9, "http://c.example/9", "y" * 999), (10, "http://c.example/9", "y" * 999), (None, "n", big), (3, "http://a.example/2", big),
        (11, "w", "z" * 500 + "é" * 250), (12, "w", "z" * 500 + "é" * 250),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).withColumn("response", F.lit(1))


def test_archives(spark, pages):
    folder = new_folder(spark, "test-warc")
    warc.write_archives(pages, folder, archive_bytes=3000)
    runs = warc.read_runs(spark, folder)
    got = warc.merged_index(runs).collect()
    payload = {(r["page_id"], r["url"]): (r["html"] or "").encode() for r in pages.collect()}
    by_content = {}
    for (i, _), content in payload.items():
        if i is not None:
            by_content[content] = max(i, by_content.get(content, i))
    expected = []
    for r in pages.collect():
        content, i = (r["html"] or "").encode(), r["page_id"]
        first = by_content.get(content)
        refers = first if len(content) >= 1000 and first != i else None
        expected.append((i, len(content), hashlib.sha1(content).hexdigest(), "response" if refers is None else "revisit", refers))
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == Counter(expected)
    order = [(r["url_key"], r["captured"], r["page_id"] is not None, r["page_id"] or 0) for r in got]
    assert order == sorted(order)
    kept = {(r["page_id"], bytes(r["payload"])) for r in warc.read_payloads(spark, folder).collect()}
    assert kept == {(e[0], (r["html"] or "").encode()) for e, r in zip(expected, pages.collect(), strict=True) if e[3] == "response"}
    path = folder.removeprefix("file:")
    files = [os.path.join(path, f) for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) > 1 and sum(gzip.open(f).read().count(b"WARC-Record-ID") for f in files) == len(expected)  # any reader
    assert len({r["run"] for r in got}) == len(files)


def test_archives_of_nothing(spark, pages):
    folder = new_folder(spark, "test-warc")
    warc.write_archives(pages.limit(0), folder)
    assert warc.merged_index(warc.read_runs(spark, folder)).count() == 0


def test_damaged_archive():
    record = warc._record(1, "u", b"payload", 5, hashlib.sha1(b"payload").hexdigest(), None)
    whole = zlib.compress(record, 3, 31) * 2
    assert [x[4] for x in warc._parsed(whole + b"\0")] == [b"payload"] * 2
    with pytest.raises(ValueError, match="ends within"):
        list(warc._parsed(whole[:-5]))
    with pytest.raises(ValueError, match="digest"):
        list(warc._parsed(zlib.compress(record.replace(b"payload", b"paYload"), 3, 31)))


def test_tokens_are_those_of_the_library(spark, rng):
    tokenizer = Tokenizer.from_file(TOKENS)
    odd = ["a  b", "é à b", "  x  y \n z ", "<|endoftext|> a <|endoftext|>b", "x <|endoftext|>", "日本 語 テ", "x　y", "it's  'll we've 12 34", "\u0085 a b\t c", "ß ü", "a ", " a", "", "À   É", "\U0001f4a5 boom", "a  b c"]
    pieces = ["a", "é", " ", "\n", "1", "!", "'s", " ", "語", " b", " ", "<|endoftext|>", "\t", "Ä"]
    texts = odd + ["".join(rng.choice(pieces) for _ in range(60)) for _ in range(300)]
    texts += [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    encoder = packing.Encoder(TOKENS)
    expected = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(2):  # unknown and known words
        got = []
        for rows, places, data in packing.slices(pa.array([t.encode() for t in texts], pa.binary()), 3000):
            ids, first = encoder.encode(data, places)
            got += [ids[first[d] : first[d + 1]].tolist() for d in range(len(rows))]
        assert got == expected


def check_packing(rows, pieces, capacity):
    tokenizer = Tokenizer.from_file(TOKENS)
    ids = sorted((i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]) for i, t in rows)
    expected = Counter()
    for i, own in ids:
        for at in range(0, len(own), capacity):
            part = own[at : at + capacity]
            expected[i, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(own)] += 1
    assert Counter((p["doc_id"], p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]) for p in pieces) == expected
    sequences = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append(p)
    for own in sequences.values():
        own.sort(key=lambda p: p["offset"])
        total = sum(p["length"] for p in own)
        assert [p["offset"] for p in own] == [sum(p["length"] for p in own[:k]) for k in range(len(own))] and total <= capacity
        assert {p["padded_length"] for p in own} == {total if total & (total - 1) == 0 else capacity}
    return sequences


def test_packing(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pieces = QUERIES["op7_packing"](spark, "/root/testdata/sf0.01").collect()
    sequences = check_packing([(r["doc_id"], r["text"]) for r in documents.collect()], pieces, 1024)
    tokens = sum(p["length"] for p in pieces)
    assert len(sequences) * 1024 <= 1.02 * tokens + 1024


def test_packing_of_odd_rows(odd, odd_rows, empty):
    docs = odd.filter("doc_id IS NOT NULL").withColumn("offset", F.lit("clash")).repartition(5)
    check_packing([(r[0], r[1]) for r in odd_rows if r[0] is not None], packing.pack(docs, TOKENS, capacity=64).collect(), 64)
    assert packing.pack(odd, TOKENS).filter("doc_id IS NULL").count() == 2
    assert packing.pack(empty, TOKENS).count() == 0


def test_fills_are_closest_to_the_room(rng):
    for _ in range(60):
        counts = {rng.randrange(1, 40): rng.randrange(1, 4) for _ in range(6)}
        room = rng.randrange(1, 64)
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1)}
        fill = packing._closest(counts, room)
        assert sum(n * c for n, c in fill.items()) == max(s for s in sums if s <= room) and all(c <= counts[n] for n, c in fill.items())


def test_fills_use_everything_once(rng):
    counts = {n: rng.randrange(0, 2000) for n in range(1, 128)}
    used = Counter()
    for fill, times in packing.minimum_slack(counts, 128):
        assert times > 0 and sum(n * c for n, c in fill.items()) <= 128
        for n, c in fill.items():
            used[n] += c * times
    assert used == +Counter(counts)


def vectors_of(rng):
    """A tight group, a loose one, chains, pairs, copies, and what has no direction."""
    rng = np.random.default_rng(rng.randrange(100))
    def around(x, spread, n):
        return [x + rng.normal(0, spread, len(x)) for _ in range(n)]
    dim = 16
    out = around(rng.normal(size=dim), 0.05, 70) + around(rng.normal(size=dim), 0.23, 60)
    for _ in range(20):
        out += around(rng.normal(size=dim), 0.1, 2)
    step, x = rng.normal(size=dim), rng.normal(size=dim)
    out += [x + 0.12 * k * step for k in range(25)]
    out += [out[0]] * 30 + [3 * out[1]] + list(rng.normal(size=(100, dim)))
    rows = [(i * 3, v.tolist()) for i, v in enumerate(out)]
    rows += [(9001, None), (9002, []), (9003, [0.0] * dim), (9004, [1.0] * (dim - 1) + [None]), (9005, [float("nan")] + [1.0] * (dim - 1)), (9006, [float("inf")] * dim)]
    rows += [(9007, [1.0, 0.0]), (9008, [1.0, 0.1]), (0, rows[0][1]), (None, rows[0][1]), (None, None), (9009, [1e-200] * dim), (9010, [1e200] * dim)]
    return rows


def unit(v):
    if v is None or not v or any(x is None for x in v) or not np.isfinite(v).all() or not np.any(v):
        return None
    x = np.array(v) / np.max(np.abs(v))
    return x / np.linalg.norm(x)


def test_links_of_vectors(spark, rng):
    rows = vectors_of(rng)
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("node", F.lit("clash")).withColumn("unit", F.lit(1))
    units = [unit(v) for _, v in rows]
    links = [(i, j) for i, a in enumerate(units) for j, b in enumerate(units[:i]) if a is not None and b is not None and len(a) == len(b) and a @ b >= 0.95]
    degree = Counter(x for pair in links for x in pair)
    ids = [r[0] for r in rows]
    expected = Counter()
    for k, group in enumerate(plain.components(len(rows), links)):
        component = plain.least(ids, group)
        expected[ids[k], degree[k], component, ids[k] == component] += 1
    got = neighbours.near_links(docs).collect()
    assert Counter((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got if r["vec_id"] is not None) == Counter({k: n for k, n in expected.items() if k[0] is not None})
    assert Counter((r["n_links"], r["component_id"]) for r in got if r["vec_id"] is None) == Counter((k[1], k[2]) for k in expected.elements() if k[0] is None)
    assert neighbours.near_links(docs.limit(0)).count() == 0


def test_links_of_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = table.collect()
    x = np.array([r["embedding"] for r in rows], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    got = {r["vec_id"]: r["n_links"] for r in QUERIES["op8_embedding_links"](spark, "/root/testdata/sf0.1").collect()}
    found = sum(got.values())
    assert all(got[r["vec_id"]] <= n for r, n in zip(rows, near.sum(1), strict=True)) and found >= 0.95 * near.sum()


def test_blocks_are_bounded(spark, monkeypatch):
    """A group of copies is dealt over blocks; every row still meets some of its group."""
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    rng = np.random.default_rng(0)
    base = rng.normal(size=8)
    units = [base + rng.normal(0, 1e-3, 8) for _ in range(200)]
    rows = [(i, (u / np.linalg.norm(u)).astype(np.float32).tobytes()) for i, u in enumerate(units)]
    lists = neighbours._blocks(spark.createDataFrame(rows, "node long, unit binary").withColumn("key", F.lit(1)), "key", 5).collect()
    assert {r["node"] for r in lists} == set(range(200)) and all(len(r["ids"]) == 5 for r in lists)


def test_links_beside_a_frequent_vector(spark, monkeypatch):
    """The rounds find no pair; many links in one dense group must not hide that."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=16)
    out = [base + rng.normal(0, 0.02, 16) for _ in range(300)]
    for _ in range(15):
        x = rng.normal(size=16)
        out += [x, x + rng.normal(0, 0.02, 16)]
    real = neighbours._edges

    def edges(*args):
        found = real(*args)
        often = found.select("a").unionByName(found.select(F.col("b").alias("a"))).groupBy("a").count().filter("count > 3").select("a")
        return found.join(often, "a", "left_semi")

    monkeypatch.setattr(neighbours, "_edges", edges)
    monkeypatch.setattr(neighbours, "MOST_ROUNDS", 1)
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(out)], "vec_id long, embedding array<double>")
    x = np.array(out) / np.linalg.norm(out, axis=1)[:, None]
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    got = {r["vec_id"]: r["n_links"] for r in neighbours.near_links(docs).collect()}
    assert [got[i] for i in range(len(out))] == near.sum(1).tolist()


def test_neighbours_of_neighbours_suffice(spark, monkeypatch):
    """Buckets at the start only: what the lists lead to finds nine links of ten, and more than the start did."""
    monkeypatch.setattr(neighbours, "TABLES", 2)
    rng = np.random.default_rng(5)
    out = [c + rng.normal(0, 0.17, 24) for c in rng.normal(size=(120, 24)) for _ in range(8)]
    x = np.array(out) / np.linalg.norm(out, axis=1)[:, None]
    near = np.triu(x @ x.T >= 0.95, 1)
    nodes = spark.createDataFrame([(i, u.tobytes(), 1) for i, u in enumerate(x)], "node long, unit binary, weight long")
    graph = neighbours.staged(neighbours._best(neighbours._first(nodes, 24, 9, 10, 0), 0.95, 10), "graph")

    def recall():
        found = {(r["b"], r["a"]) for r in neighbours._edges(graph, nodes, 0.95).collect()}
        assert all(near[a, b] for a, b in found)
        return len(found) / near.sum()

    before = recall()
    for turn in (1, 2, 3):
        graph = neighbours.staged(neighbours._best(neighbours._met(graph, nodes, 16, turn).unionByName(graph), 0.95, 10), "graph")
    assert before < 0.9 < recall()
