"""Substring dedup, Jaccard join, line dedup and decontamination against brute force."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import plain
import pyarrow as pa
import pytest
from conftest import sentence
from pyspark.sql import functions as F

from stationflow.llm import boilerplate, jaccard, substrings, tiling

SF = "/root/testdata/sf0.001"


def as_counter(rows):
    return Counter(tuple(r) for r in rows)


def test_repeats_of_odd_rows(odd, odd_rows):
    for length, seed in ((35, 12), (8, 3), (5, 5)):
        got = substrings.remove_repeats(odd, length=length, seed_words=seed).collect()
        expected = plain.kept_words([r[1] for r in odd_rows], length)
        assert as_counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got) == as_counter(
            (row[0], n, n - len(kept), b" ".join(kept).decode()) for row, (n, kept) in zip(odd_rows, expected, strict=True)
        )
        for r in got:
            assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]


def test_repeats_do_not_depend_on_partitions(spark, odd, odd_rows):
    one = as_counter((r["doc_id"], r["kept"]) for r in substrings.remove_repeats(odd.repartition(1), length=20, seed_words=7).collect())
    many = as_counter((r["doc_id"], r["kept"]) for r in substrings.remove_repeats(odd.repartition(17), length=20, seed_words=7).collect())
    assert one == many


def test_seed_is_the_last_least():
    rng = np.random.default_rng(1)
    for size in (1, 2, 3, 7, 24):
        values = rng.integers(0, 5, 60)
        got = substrings._rightmost_least(values, size)
        for i, at in enumerate(got.tolist()):
            own = values[i : i + size].tolist()
            assert at == i + max(j for j, v in enumerate(own) if v == min(own))


def check_components(rows, got, n, share):
    ids, texts = [r[0] for r in rows], [r[1] for r in rows]
    groups = plain.components(len(rows), plain.jaccard_links(texts, n, share))
    expected = as_counter((i, len(plain.shingle_set(t, n)), plain.least(ids, g)) for i, t, g in zip(ids, texts, groups, strict=True))
    assert as_counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == expected


@pytest.mark.parametrize(("n", "share"), [(3, 90), (5, 80), (1, 50), (2, 100)])
def test_components_of_odd_rows(odd, odd_rows, n, share):
    check_components(odd_rows, jaccard.near_duplicates(odd, n=n, share=share).collect(), n, share)


def test_groups_of_near_copies(spark):
    """Edits around the threshold, so that some pairs link only through others."""
    rng = random.Random(2)
    rows = []
    for group in range(6):
        base = sentence(rng, rng.choice((12, 40, 150))).split()
        for _ in range(25):
            own = list(base)
            for _ in range(rng.choice((0, 0, 1, 1, 2, 3, 6))):
                own[rng.randrange(len(own))] = f"w{rng.randrange(10**6)}"
            rows.append((len(rows) * 7 + group, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for n, share in ((3, 90), (5, 80)):
        check_components(rows, jaccard.near_duplicates(docs, n=n, share=share).collect(), n, share)


def test_prefix_that_asks_for_more_matches():
    assert jaccard._matches(np.array([1.0, 1, 1, 1, 1]), 2) >= 1
    assert jaccard._matches(np.array([900.0, 900, 1, 1, 1]), 2) == 4  # longer by tokens that cost nothing
    assert jaccard._matches(np.array([1.0, 1, 900, 900, 900]), 2) == 1
    assert [jaccard._prefix(s, 90) for s in (1, 9, 10, 100)] == [1, 1, 2, 11]


def test_one_of_each(odd, odd_rows):
    kept = jaccard.one_of_each(odd, n=3, share=90)
    assert kept.columns == odd.columns
    ids, texts = [r[0] for r in odd_rows], [r[1] for r in odd_rows]
    groups = plain.components(len(ids), plain.jaccard_links(texts, 3, 90))
    for group in {tuple(g) for g in groups}:
        own = [r for r in kept.collect() if (r["doc_id"], r["text"]) in [(ids[x], texts[x]) for x in group]]
        assert own or any(ids[x] is None for x in group)


def test_lines(spark):
    rows = [(i, f"own {i}\nfoot\n\nnav" if i else "own\nnav\nnav", "a") for i in range(8)]
    rows += [(20, "foot\nonly", "b"), (21, None, "b"), (22, "", "b"), (23, "foot\nnav", None), (24, "x\n", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_lines", F.lit("clash"))
    got = {r["doc_id"]: r for r in boilerplate.drop_boilerplate(docs, ratio=0.5, min_pages=2).collect()}
    assert got[0]["text"] == "own" and got[0]["n_dropped"] == 2
    assert got[3]["text"] == "own 3\n" and (got[3]["n_lines"], got[3]["n_dropped"]) == (4, 2)
    assert got[20]["text"] == "foot\nonly" and got[21]["text"] is None and got[22]["text"] == "" and got[24]["text"] == "x\n"
    assert got[23]["text"] == "foot\nnav"
    assert boilerplate.drop_boilerplate(docs.limit(0)).count() == 0
    plan = boilerplate.drop_boilerplate(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_odd_rows_keep_their_lines(odd, odd_rows):
    assert boilerplate.drop_boilerplate(odd).count() == len(odd_rows)


def test_tiling(spark):
    rng = random.Random(4)
    items = [(k, sentence(rng, 30)) for k in range(5)] + [(5, "too short"), (6, None), (2, sentence(rng, 20))]
    word = dict(items[:5])[1].split()
    texts = {
        1: dict(items[:5])[0].upper(),
        2: sentence(rng, 50) + " " + " ".join(word[20:] + word[10:20] + ["x"] + word[:10]) + " " + sentence(rng, 50),
        3: " ".join(word[:12]) + " " + sentence(rng, 30),
        4: sentence(rng, 400),
        5: None,
        6: "",
        7: "it is Too  short and too\nshort",
        9: "too long, short too",
        8: " ".join(word[:15]) + " y " + " ".join(word[:15]),  # the same half twice
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("item_id", F.lit("clash")).withColumn("coverage", F.lit(1))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    expected = {}
    for i, text in texts.items():
        for j, (item, own) in enumerate(items):
            w = plain.words(own, lower=True)
            share = plain.tiled(w, plain.words(text, lower=True), min(5, len(w))) / len(w) if w else 0  # short items whole
            if share >= 0.5:
                expected[i, item, j] = share
    got = tiling.contamination(docs, benchmark).collect()
    assert sorted((r["doc_id"], r["item_id"], round(r["coverage"], 9)) for r in got) == sorted((i, k, round(s, 9)) for (i, k, _), s in expected.items())
    assert {i for i, _, _ in expected} >= {1, 2, 7, 8} and all(len(r["tiles"]) >= 3 for r in got if r["doc_id"] == 2)
    clean = tiling.decontaminated(docs, benchmark)
    assert clean.columns == docs.columns and sorted(r["doc_id"] for r in clean.collect()) == sorted(set(texts) - {i for i, _, _ in expected})
    assert tiling.decontaminated(docs, benchmark.limit(0)).count() == len(texts) and tiling.contamination(docs.limit(0), benchmark).count() == 0


def test_tiles_in_slices(spark, monkeypatch):
    """A bound that one item fills gives as many passes, and the same result."""
    docs, benchmark = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = sorted((r["doc_id"], r["item_id"]) for r in tiling.contamination(docs, benchmark).collect())
    monkeypatch.setattr(tiling, "SLICE_BYTES", 2000)
    assert sorted((r["doc_id"], r["item_id"]) for r in tiling.contamination(docs, benchmark).collect()) == whole and whole


def test_repetitive_documents(spark, rng, monkeypatch):
    """Words that repeat cost their number, not the pairs of their places, and give the same tiles."""
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randrange(1, 60))) for _ in range(30)] + ["a " * 300, None, "a b " * 40]
    items = [(k, " ".join(rng.choice("ab") for _ in range(rng.randrange(1, 30)))) for k in range(12)] + [(12, "a " * 50), (13, "b a " * 20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    paired = sorted(map(str, tiling.contamination(docs, benchmark).collect()))
    index, _ = next(tiling._indexes(benchmark, "item_id", "text", 5))
    column = pa.array([(t or "").encode() for t in texts], pa.binary())
    monkeypatch.setattr(tiling, "PAIRS", 0)
    found = sorted((r, j, t) for r, j, t in tiling._held(column, index, 0.5))
    monkeypatch.setattr(tiling, "PAIRS", 1 << 20)
    assert found == sorted((r, j, t) for r, j, t in tiling._held(column, index, 0.5)) and len(found) == len(paired) > 50
    for _ in range(200):
        k, a, b = rng.choice((1, 2, 3, 5)), *([rng.randrange(rng.choice((1, 2, 4))) for _ in range(rng.randrange(1, 30))] for _ in range(2))
        seeds = [(i, d) for i in range(len(a) - k + 1) for d in range(len(b) - k + 1) if a[i : i + k] == b[d : d + k]]
        both = tiling.tiles_of_words(np.array(a, np.uint64), np.array(b, np.uint64), k)
        assert both == (tiling.tiles(np.array(seeds), k) if seeds else [])


def test_long_repetitive_document():
    """Two thousand equal words in two hundred thousand."""
    own = tiling._index(pa.array([1]), pa.array([b"again " * 2000], pa.binary()), 5)
    tracemalloc.start()
    found = list(tiling._held(pa.array([b"again " * 200_000], pa.binary()), own, 0.5))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [(0, 0, [(0, 0, 2000)])] and peak < 500 << 20


def test_tiles_are_greedy(rng):
    for _ in range(40):
        item, doc = ([rng.choice(b"abcde") for _ in range(rng.randrange(6, 30))] for _ in range(2))
        item, doc = [bytes([x]) for x in item], [bytes([x]) for x in doc]
        seeds = [(i, d) for i in range(len(item) - 1) for d in range(len(doc) - 1) if item[i : i + 2] == doc[d : d + 2]]
        if seeds:
            found = tiling.tiles(np.array(seeds), 2)
            assert all(item[i : i + n] == doc[d : d + n] for i, d, n in found)
            assert len({x for i, _, n in found for x in range(i, i + n)}) == len({x for _, d, n in found for x in range(d, d + n)}) == sum(n for _, _, n in found)
            assert max(n for _, _, n in found) == max(n for n in range(2, 30) for i in range(len(item) - n + 1) for d in range(len(doc) - n + 1) if item[i : i + n] == doc[d : d + n])


def test_empty_tables(empty):
    assert substrings.remove_repeats(empty).count() == 0
    assert jaccard.near_duplicates(empty).count() == 0
    assert jaccard.one_of_each(empty).count() == 0
