"""Resampling, suffix tree and toxicity: exact parts by brute force, models by held-out rows."""

import math
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pandas as pd
import plain
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stationflow import session
from stationflow.llm import importance, suffixtree, toxicity
from stationflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def held(n, rest):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n)) == rest


def test_resampling_keeps_the_clean(documents, labels):
    kept = {r["doc_id"] for r in importance.importance(documents, labels).filter("kept").collect()}
    verdict = {r["doc_id"]: r["quality"] for r in labels.collect()}
    clean, junk = ([i for i, q in verdict.items() if q == x] for x in (1, 0))
    assert sum(i in kept for i in clean) >= 0.98 * len(clean) and sum(i in kept for i in junk) <= 0.05 * len(junk)
    full = importance.resample(documents, labels)
    assert {r["doc_id"] for r in full.collect()} == kept and full.columns == [*documents.columns, "log_weight", "resample_key"]


def test_weights_of_the_ratio(spark):
    """A document's weight is the sum over its n-grams of log p_target - log p_raw."""
    docs = spark.createDataFrame([(1, "a b"), (2, "c c c"), (3, None), (4, ""), (4, "a")], "doc_id long, text string").withColumn("log_weight", F.lit("clash"))
    marks = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (None, 1), (9, None)], "doc_id long, quality int")
    got = {(r["doc_id"], r["text"]): r["log_weight"] for r in importance.importance(docs, marks).join(docs.select("doc_id", "text"), "doc_id").collect() if r["doc_id"] != 4}
    counts = {}
    for w in importance.words(pa.array([b"a b", b"c c c", b"", b"", b"a"], pa.binary())):
        for buckets, begin in zip(*importance._features(w), strict=True):
            for bucket, word in zip(buckets.tolist(), begin.tolist(), strict=True):
                counts.setdefault(int(np.searchsorted(w.first, word, "right")) - 1, []).append(bucket)
    raw, target = Counter(x for c in counts.values() for x in c), Counter(counts[0])
    def log_ratio(bucket):
        part, size = (0, importance.WORD_BUCKETS) if bucket < importance.WORD_BUCKETS else (importance.WORD_BUCKETS, importance.SHAPE_BUCKETS)
        def total(c):
            return size + sum(n for b, n in c.items() if part <= b < part + size)
        return math.log((target[bucket] + 1) / total(target)) - math.log((raw[bucket] + 1) / total(raw))
    assert got[1, "a b"] == pytest.approx(sum(map(log_ratio, counts[0]))) and got[2, "c c c"] == pytest.approx(sum(map(log_ratio, counts[1])))
    assert got[3, None] == 0


def test_resampling_of_odd_rows(odd, odd_rows, empty, labels):
    assert importance.importance(odd, labels.limit(0)).filter("kept").count() == len(odd_rows)
    assert importance.resample(odd, labels).columns == [*odd.columns, "log_weight", "resample_key"]
    assert importance.importance(empty, labels).count() == 0


def test_kth_largest(spark, rng):
    values = [rng.choice([rng.gauss(0, 1e6), rng.gauss(0, 1e-6), 0.0, 7.0]) for _ in range(500)]
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    for k in (1, 2, 250, 499, 500):
        assert importance.kth_largest(rows, "x", k, bins=8) == sorted(values)[-k]


def test_base_scores(spark, odd, odd_rows, documents):
    sample = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    for docs, rows in ((documents, sample), (odd, [(r[0], r[1]) for r in odd_rows])):
        got = suffixtree.scores(docs, held(7, 2)).collect()
        expected = plain.base_scores(*zip(*rows, strict=True))
        key = lambda x: (x[0] is None, x[0], x[1:])
        found = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got), key=key)
        for a, b in zip(found, sorted(((i, *e) for (i, _), e in zip(rows, expected, strict=True)), key=key), strict=True):
            assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)


def test_tree_beats_the_base_on_held_out_texts(documents):
    rows = suffixtree.scores(documents, held(7, 2)).filter("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert (rows[0] - rows[1]) / rows[2] > 0.2


def test_scores_without_training(odd, empty):
    rows = suffixtree.scores(odd, F.lit(True)).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["score"] == 0 for r in rows)
    assert suffixtree.scores(empty, F.lit(False)).count() == 0


def test_toxicity_on_held_out_texts(spark, labels):
    rows = QUERIES["op10_toxicity"](spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").filter("held_out").collect()
    toxic, clean = ([r["score"] for r in rows if r["toxic"] == x] for x in (1, 0))
    assert np.mean([a > b for a in toxic for b in clean]) > 0.93
    assert np.mean([x >= 0.5 for x in toxic]) > 0.8 and np.mean([x < 0.5 for x in clean]) > 0.97


def test_toxicity_of_odd_rows(odd, odd_rows, empty, labels):
    docs = odd.withColumn("lang", F.coalesce("lang", F.lit(None)))
    for marks in (labels, labels.limit(0)):
        rows = toxicity.toxicity(docs, marks, held(5, 0)).collect()
        assert len(rows) == len(odd_rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert toxicity.toxicity(empty, labels, held(5, 0)).count() == 0


def test_toxicity_learns_nothing_from_held_out_rows(spark):
    docs = spark.createDataFrame([(i, f"bad w{i}" if i % 2 else f"good w{i}", "en") for i in range(300)], "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(i, i % 2 if zlib.crc32(str(i).encode()) % 5 else 1 - i % 2) for i in range(300)], "doc_id long, toxic int")
    rows = toxicity.toxicity(docs, marks, held(5, 0)).collect()
    assert all(r["predicted"] == r["doc_id"] % 2 for r in rows)


def test_toxicity_learns_from_every_labelled_text(spark, monkeypatch):
    """Texts of any length, in parts; counts of all of them, and thresholds from all spare ones."""
    monkeypatch.setattr(toxicity, "PART_BYTES", 1 << 20)
    filler = "some words that stand anywhere " * 1200  # more than 32 KiB
    docs = spark.createDataFrame([(i, f"{filler} {'vile' if i % 2 else 'kind'}", "en" if i % 3 else None) for i in range(120)], "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(i, i % 2 if zlib.crc32(str(i).encode()) % 5 else 1 - i % 2) for i in range(120)], "doc_id long, toxic int")
    rows = toxicity.toxicity(docs.repartition(3), marks, held(5, 0)).collect()
    assert len(rows) == 120 and all(r["predicted"] == r["flagged"] == r["doc_id"] % 2 for r in rows)


def test_best_threshold():
    rng = np.random.default_rng(1)
    score = rng.integers(0, 40, 300) / 40
    toxic = rng.random(300) < score
    place = np.minimum(score * toxicity.BINS, toxicity.BINS - 1).astype(int)
    counts = pd.DataFrame({"bin": place, "n": 1, "toxic": toxic}).groupby("bin", as_index=False).sum()
    found = toxicity._best_threshold(counts)
    f1 = [2 * toxic[score >= x].sum() / ((score >= x).sum() + toxic.sum()) for x in np.arange(toxicity.BINS) / toxicity.BINS]
    assert 2 * toxic[score >= found].sum() / ((score >= found).sum() + toxic.sum()) == max(f1)


def test_words_in_blocks_score_alike(monkeypatch):
    rng = np.random.default_rng(0)
    model = toxicity.Model(rng.normal(size=(toxicity.BUCKETS + 1, 8)).astype(np.float32), [rng.normal(size=(n * 8, 8)).astype(np.float32) for n in (1, 2, 3)], [rng.normal(size=8).astype(np.float32) for _ in range(3)], rng.normal(size=24).astype(np.float32), 0.1, {None: 0.5})
    model.embeddings[-1] = 0
    texts = pa.array([b"", b"one", b"a b c d e f g", b"x " * 50, b"y z"], pa.binary())
    whole = toxicity.scored(model, texts)
    alone = np.concatenate([toxicity.scored(model, texts[i : i + 1]) for i in range(5)])
    monkeypatch.setattr(toxicity, "_BLOCK", 5)
    assert whole == pytest.approx(alone, abs=1e-6) and toxicity.scored(model, texts) == pytest.approx(whole, abs=1e-6)


def test_rare_contexts_predict(spark):
    """Twelve times in two million words, and by three words where two leave it open."""
    filler = [(0, "x " * 2_000_000)]
    pairs = [(i, "zig zag") for i in range(1, 13)]
    longer = [(i, f"{'a' if i % 2 else 'b'} m n {'p' if i % 2 else 'q'}") for i in range(100, 140)]
    held = [(1000, "zig zag"), (1001, "a m n p"), (1002, "a m n q")]
    docs = spark.createDataFrame([*filler, *pairs, *longer, *held], "doc_id long, text string")
    got = {r["doc_id"]: r for r in suffixtree.scores(docs, F.col("doc_id") >= 1000).filter("held_out").collect()}
    assert got[1000]["score"] > got[1000]["base_score"] + 8
    assert got[1001]["score"] > got[1002]["score"] + 0.8


@pytest.mark.parametrize("least_count, sent", [(2, 0.01), (3, 1.0), (10, 4e-6)])
def test_suffix_tree_by_brute_force(spark, odd, odd_rows, rng, monkeypatch, least_count, sent):
    """Contexts of every length, their test, the states and the scores."""
    monkeypatch.setattr(suffixtree, "_SENT", sent)
    chain = {"a": "bbbc", "b": "cccda", "c": "abe", "d": "eeef", "e": "fa", "f": "a"}
    texts = [r[1] for r in odd_rows if r[1] is None or len(r[1]) < 5000]
    for _ in range(60):
        w = ["a", "b"]
        for _ in range(rng.randrange(40)):
            w.append(rng.choice(chain[w[-1]]) if rng.random() < 0.5 or w[-2] != "c" else "d")
        texts.append(" ".join(w))
    texts += ["x y z x y z x y w"] * 12 + ["over " * 9] * 11
    held_out = [i % 5 == 0 for i in range(len(texts))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 AS key", "'x' AS ctx", "2 AS low", "3 AS score")
    got = {r["doc_id"]: r["score"] for r in suffixtree.scores(docs.repartition(3), F.col("doc_id") % 5 == 0, least_count=least_count).collect()}
    expected, longest = plain.suffix_tree_scores(texts, held_out, least_count, 0.05)
    assert longest >= 2
    assert [got[i] for i in range(len(texts))] == pytest.approx(expected, abs=1e-9)


@pytest.mark.parametrize("words_sent, hot, turns, block", [(1 << 22, 1 << 20, 4, 1), (0, 2, 2, 2), (40, 20, 3, 16)])
def test_suffix_tree_past_what_tasks_hold(spark, odd, odd_rows, rng, monkeypatch, words_sent, hot, turns, block):
    """Words that tasks don't hold, words dealt to all parts, turns, blocks of lengths; no n-gram's value sent. Rows may share an id."""
    for name, value in {"_BLOCK": block, "_SENT": 1.0, "_SENT_WORDS": words_sent, "_HOT": hot, "_TURNS": turns, "_TURN_TOKENS": 1, "_PART_TOKENS": 200}.items():
        monkeypatch.setattr(suffixtree, name, value)
    texts = [r[1] for r in odd_rows if r[1] is None or len(r[1]) < 5000]
    texts += [" ".join(rng.choice("aaabbcd") for _ in range(rng.randrange(30))) for _ in range(50)] + ["l m n o l m n o l m k"] * 9 + ["l m n o p q"] * 3
    texts += [f"{x} s t u v w r s t u {y}" for x, y in ("ab", "cd")] * 5
    rows = [(i // 2 if i > 20 else i, t) for i, t in enumerate(texts)] + [(None, "a b"), (0, texts[0])]
    held_out = [i is not None and i % 5 == 0 for i, _ in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS key", "'x' AS ctx", "2 AS part", "3 AS _rare")
    got = suffixtree.scores(docs.repartition(3), F.col("doc_id") % 5 == 0, least_count=3).collect()
    expected, longest = plain.suffix_tree_scores([t for _, t in rows], held_out, 3, 0.05)
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    found, wanted = sorted(((r["doc_id"], r["score"]) for r in got), key=key), sorted(((i, e) for (i, _), e in zip(rows, expected, strict=True)), key=key)
    assert longest >= 3 and [x[0] for x in found] == [x[0] for x in wanted]
    assert [x[1] for x in found] == pytest.approx([x[1] for x in wanted], abs=1e-9)


def test_suffix_tree_looks_up_only_what_follows_states():
    """A text asks for n-grams after contexts whose suffixes may be states, not for all that a filling bitmap lets through; in small batches."""
    rng = np.random.default_rng(2)
    half = rng.integers(0, 1 << 63, 16, np.uint64) << np.uint64(1)  # lets through half of all keys
    states, grams = suffixtree.Bitmap(10, half), suffixtree.Bitmap(10, ~np.zeros(16, np.uint64))
    none = np.zeros(0, np.uint64), np.zeros(0)
    batch = pa.RecordBatch.from_pydict({"_key": [1, 2], "_text": pa.array([" ".join(map(str, range(5000))).encode(), b""], pa.binary())})
    sent = SimpleNamespace(value=suffixtree.Sent(*none, states, grams, 300, 4))
    asked = sum(len(x[3]) for x in suffixtree._opened(suffixtree._longer_grams([batch], sent)))
    assert 0 < asked < 5 * 5000
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(suffixtree, "_FLUSH", 100)
        flushed = [x for x in suffixtree._opened(suffixtree._longer_grams([batch], sent))]
    assert sum(len(x[3]) for x in flushed) == asked


def test_suffix_tree_takes_stretches_a_few_at_a_time(monkeypatch):
    monkeypatch.setattr(suffixtree, "_WORDS", 10)
    lists = [[*range(n)] for n in (4, 6, 25, 0, 3)]
    batch = pa.RecordBatch.from_pydict({"words": pa.array(lists, pa.list_(pa.int64())), "keys": pa.array(lists, pa.list_(pa.int64()))})
    found = list(suffixtree._stretched([batch]))
    assert [len(x[0]) for x in found] == [10, 25, 3] and all(np.array_equal(x[0], x[2].astype(np.uint64)) and np.array_equal(x[0], x[1]) for x in found)


def test_suffix_tree_leaves_only_sums_on_disk(spark, documents):
    """Its n-grams, words and the files of its shuffles are gone before the result is read."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, began = spark.conf.get(name), session.mark()
    scores = suffixtree.scores(documents.limit(200), held(7, 2))
    assert {f.rsplit("/", 1)[1].split("-")[0] for _, f in session._FOLDERS[began:]} == {"sums"}
    assert spark.conf.get(name) == before and scores.count() == 200


def test_states_sum_to_one():
    """The plain tree's predictions of all words and an unknown one, in every state."""
    texts = ["a b c a b d a b c", "a b c d", "b c a b c"] * 4
    predict, vocabulary, states = plain.suffix_tree([plain.words(t) + [None] for t in texts], 3, 0.01)
    assert any(len(s) > 1 for s in states)
    for state in states:
        assert sum(predict(state, w) for w in vocabulary) + predict(state, b"unknown") == pytest.approx(1)


def test_resampling_selects_by_brute_force(spark, rng):
    """The kept documents are those of the k greatest sums of weight and noise, k from the posteriors."""
    texts = [" ".join(rng.choice(("good", "fine", "text") if i % 2 else ("JUNK!!", "$$$", "x9")) for _ in range(rng.randrange(1, 6))) for i in range(200)]
    docs = spark.createDataFrame([*enumerate(texts), (7, texts[7]), (None, texts[8])], "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(0, 120)], "doc_id long, quality int")
    rows = importance.importance(docs.repartition(4), marks).collect()
    share = 0.5
    k = min(len(rows), math.ceil(sum(min(1.0, share * math.exp(min(r["log_weight"], 50))) for r in rows) - 1e-9))
    threshold = sorted((r["resample_key"] for r in rows), reverse=True)[k - 1]
    assert 0 < k < len(rows) and all(r["kept"] == (r["resample_key"] >= threshold) for r in rows)
    noise = [r["resample_key"] - r["log_weight"] for r in rows]
    assert len(set(noise)) == len({r["doc_id"] for r in rows}) and -3 < np.mean(noise) - 0.5772 < 3


def test_forward_pass_by_brute_force():
    """A text's score: every filter at every place, the largest of each, one layer, the logistic function."""
    rng = np.random.default_rng(1)
    model = toxicity.Model(rng.normal(size=(toxicity.BUCKETS + 1, 8)).astype(np.float32), [rng.normal(size=(n * 8, 8)).astype(np.float32) for n in (1, 2, 3)], [rng.normal(size=8).astype(np.float32) for _ in range(3)], rng.normal(size=24).astype(np.float32), 0.1, {None: 0.5})
    model.embeddings[-1] = 0
    texts = [b"", b"one", b"two words", b"a b c d e f g", b"again " * 30]
    got = toxicity.scored(model, pa.array(texts, pa.binary()))
    for text, score in zip(texts, got, strict=True):
        assert score == pytest.approx(plain.convolved(model, toxicity, text), abs=1e-5)
