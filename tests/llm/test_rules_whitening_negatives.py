"""URL rules, whitening and hard negatives against plain versions."""

import math
from itertools import combinations

import numpy as np
import pytest

from stationflow.llm import negatives, urlrules, whitening
from stationflow.llm.queries import QUERIES, URL_RULES
from pyspark.sql import functions as F

VECTORS = "vec_id long, embedding array<float>, label int, id string, _v int, planes int, anchor string"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], VECTORS)


def odd_vectors(rng, n, d, ids=None):
    """(vec_id, vector, label) with every awkward kind of vector among them."""
    rows = [(i if ids is None else ids(i), [rng.choice((-0.25, 0.0, 0.11, 0.4)) + rng.random() / 64 for _ in range(d)], rng.randrange(3)) for i in range(n)]
    rows += [(n, None, 1), (n + 1, [], 1), (n + 2, [None] * d, 1), (n + 3, [float("nan")] + [0.0] * (d - 1), 1)]
    return [*rows, (n + 4, [float("inf")] + [0.0] * (d - 1), 1), (n + 5, [0.5] * (d + 1), 1), (n + 6, [0.0] * d, 1), rows[0], (None, rows[1][1], 2), (n + 7, rows[2][1], None)]


def taking_part(rows, d):
    return [r for r in rows if r[1] is not None and len(r[1]) == d and all(c is not None and math.isfinite(c) for c in r[1])]


# Whitening


def held_against_numpy(found, rows, d, most=32, scale=64):
    part = taking_part(rows, d)
    x = np.array([[math.floor(scale * float(np.float32(c))) + 1_000_000 for c in r[1]] for r in part])
    n = len(x)
    centred = x - x.sum(0) / n
    cov = centred.T @ centred / n
    e, axes = np.linalg.eigh(cov)
    e, axes = e[::-1], axes[:, ::-1]
    k = min(most, int((e > 1e-9 * e[0]).sum()))
    assert len(found) == n * k
    by_place = {}
    for row in found:
        by_place.setdefault(row["component"], []).append(row)
    assert sorted(by_place) == list(range(1, k + 1))
    deviation = sorted((str(r[0]), sum((n * int(a) - int(s)) ** 2 for a, s in zip(xs, x.sum(0)))) for r, xs in zip(part, x))
    for c in range(k):
        got = by_place[c + 1]
        assert sorted((str(r["vec_id"]), r["deviation"]) for r in got) == deviation
        assert all(r["n"] == n and abs(r["explained"] - e[c] / np.trace(cov)) < 1e-9 and r["identity_error"] < 1e-9 for r in got)
        want = np.sort(centred @ axes[:, c] / np.sqrt(e[c]))
        have = np.sort([r["whitened"] for r in got])
        assert min(np.abs(have - want).max(), np.abs(have + want[::-1]).max()) < 1e-7


@pytest.mark.parametrize("n, d", [(150, 11), (8, 20), (60, 40)])
def test_whitening(spark, rng, n, d):
    rows = odd_vectors(rng, n, d)
    found = whitening.whiten(vectors(spark, rows).repartition(3))
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    held_against_numpy(found.collect(), rows, d)


def test_whitening_of_large_components(spark, rng):
    for n, most in ((40, 4e5), (4, 4e6)):
        rows = [(i, [rng.random() * s for s in (most, 1.0, most / 100)], 0) for i in range(n)]
        found = whitening.whiten(vectors(spark, rows), most=1).collect()
        held_against_numpy(found, rows, 3, most=1)
    with pytest.raises(Exception, match="64 bits"):
        whitening.whiten(vectors(spark, [(1, [1e30, 0.0], 0), (2, [0.0, 1.0], 0)])).collect()


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(1, [0.3, 0.4], 0)], [(1, [0.3, 0.4], 0)] * 5])
def test_whitening_without_spread(spark, rows):
    found = whitening.whiten(vectors(spark, rows))
    assert found.collect() == [] and found.columns[0] == "vec_id"


def test_principal():
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.standard_normal((90, 90)))[0]
    spectra = [np.linspace(1, 2, 90), np.r_[[1e6] * 3, [1.0] * 40, np.linspace(0.1, 0.2, 47)], 10.0 ** -np.linspace(0, 14, 90), np.r_[[2.0] * 50, [0.0] * 40], np.ones(90)]
    for spectrum in spectra:
        v = q @ np.diag(spectrum) @ q.T
        values, axes = whitening.principal((v + v.T) / 2, 32)
        assert np.abs(values - np.sort(spectrum)[::-1][:32]).max() < 1e-13 * spectrum.max()
        assert np.abs(v @ axes - axes * values).max() < 1e-13 * spectrum.max() and np.abs(axes.T @ axes - np.eye(32)).max() < 1e-13
        for at in (0.15, 0.5, 1.5, 3.0):
            assert whitening._inertia((v + v.T) / 2)(at) == (spectrum > at).sum()


# Hard negatives


def plain_negatives(rows, d, every=10, shares=(30, 90)):
    part = {}
    for i, v, label in taking_part([r for r in rows if r[0] is not None and r[2] is not None], d):
        x = [math.floor(256 * float(np.float32(c))) for c in v]
        part[i] = min(part.get(i, (label, v, x)), (label, v, x))
    out = []
    for a, (label, _, x) in part.items():
        if a % every:
            continue
        ranked = sorted((-sum(p * q for p, q in zip(x, y)), i, other) for i, (other, _, y) in part.items() if i != a)
        for score, i, other in [r for r in ranked if r[2] == label][:5]:
            fit = [r for r in ranked if r[2] != label and shares[0] * -score <= 100 * -r[0] <= shares[1] * -score][:10]
            out += [(a, i, k, r[1], -score, -r[0]) for k, r in enumerate(fit, 1)]
    return sorted(out)


@pytest.mark.parametrize("n, d", [(160, 16), (90, 5), (40, 9)])
def test_hard_negatives(spark, rng, monkeypatch, n, d):
    monkeypatch.setattr(negatives, "BATCH", 32)
    monkeypatch.setattr(negatives, "BLOCK", 3)
    monkeypatch.setattr(negatives, "ANCHORS", 4)
    rows = odd_vectors(rng, n, d, ids=lambda i: i - 20)
    rows += [(90, rows[5][1], 0), (90, rows[6][1], 2)]  # rows that share an id
    found = negatives.hard_negatives(vectors(spark, rows).repartition(5), F.col("vec_id") % 10 == 0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, found.collect())) == plain_negatives(rows, d) != []


def test_hard_negatives_of_many_equal_rows(spark):
    rows = [(i, [0.5, -0.5, 0.25], i % 2) for i in range(60)] + [(i, [0.25, -0.25, 0.1], i % 3) for i in range(60, 120)]
    found = negatives.hard_negatives(vectors(spark, rows).repartition(7), F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, found.collect())) == plain_negatives(rows, 3) != []


@pytest.mark.parametrize("rows", [[], [(1, [0.5], 0)], [(10, [0.5], 0)], [(10, [0.5], 0), (11, [-0.5], 0), (12, [0.5], 1)], [(10, None, 0)]])
def test_hard_negatives_of_nothing(spark, rows):
    found = negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") % 10 == 0)
    assert found.collect() == [] and len(found.columns) == 6


@pytest.mark.parametrize("d, low, high", [(8, -256, 255), (24, -1, 0), (16, 0, 70_000), (8, -3, 1 << 20)])
def test_scores_are_inner_products(d, low, high):
    rng = np.random.default_rng(d)
    x, y = rng.integers(low, high, (9, d), endpoint=True), rng.integers(low, high, (40, d), endpoint=True)
    bits = negatives._bits(low, high)
    planes = negatives._packed(y, bits)
    assert (negatives._unpacked(planes, d) == y).all()
    assert (negatives.scores(negatives.subset_tables(x), planes) == y @ x.T).all()


def test_scores_too_large(spark):
    with pytest.raises(OverflowError):
        negatives.hard_negatives(vectors(spark, [(10, [1e30], 0), (11, [1.0], 0)]), F.col("vec_id") % 10 == 0)


# URL rules


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    host = rest[: min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))]
    path = rest[len(host) :]
    path = path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_given(host, path):
    fit = [r for r in URL_RULES if (host == r.partition("/")[0] or host.endswith("." + r.partition("/")[0])) and path.startswith("/" + r.partition("/")[2])]
    return max(fit, key=len, default=None)


def plain_rules(baskets, blocked, least, most=3, confidence=0.5):
    found = {}
    for basket, bad in zip(baskets, blocked):
        for k in range(1, most + 1):
            for part in combinations(sorted(basket), k):
                n, hits = found.get(part, (0, 0))
                found[part] = n + 1, hits + bad
    found = {p: c for p, c in found.items() if c[1] >= least and c[1] >= confidence * c[0]}
    keep = {p: c for p, c in found.items() if all(found.get(q, (1, 0))[1] / found.get(q, (1, 0))[0] < c[1] / c[0] for k in range(1, len(p)) for q in combinations(p, k))}
    return sorted(keep, key=lambda p: (-keep[p][1] / keep[p][0], -keep[p][1], len(p), " ".join(p))), keep


ODD_URLS = [
    None, "", "no scheme", "://", "a://", "HTTP://EXAMPLE.NET/en/X", "https://example.net/en", "x://a.net", "x://net/", "x://net?a/b", "x://ne\nt/en/\n?q#f",
    "https://É.Example.COM/de/1?u=http://b.net/", "https://a.org/fr/#x?y", "https://b.example.com/de", "https://org/fr/a", "https://notexample.net/en/", "https://u:p@h.net:80/en/?&&a=1&",
    "https://a.com/" + "long/" * 50_000 + "?" + "k=v&" * 50_000, "https://a.com/q://r",
]


def url_rows(rng):
    urls = list(ODD_URLS)
    for i in range(400):
        host = rng.choice(("shop.example.org", "news.site.com", "blog.pills.example.com", "wiki.org"))
        urls.append(f"http{'s' * rng.randrange(2)}://{host}/{rng.choice(('en', 'de', 'fr'))}/{rng.choice(('buy', 'read', 'cheap-buy'))}/{i}{rng.choice(('', '?ref=x', '?ref=x&a=1', '#top'))}")
    bad = [int(u is not None and (("pills" in u and "buy" in u) or ("wiki" in u and "ref" in u)) and rng.random() < 0.9) for u in urls]
    return urls, bad


def test_url_rules(spark, rng):
    urls, bad = url_rows(rng)
    pages = spark.createDataFrame([(i, u, "h", "p", 3, 1) for i, u in enumerate(urls)], "page_id long, url string, host string, path string, items int, row int")
    said = [(i, b, 7, "t") for i, b in enumerate(bad) if i % 3]
    labels = spark.createDataFrame([*said, (32, 0, 7, "t"), (None, 1, 7, "t"), (31, None, 7, "t"), (99_999, 1, 7, "t")], "doc_id long, bad int, row int, tokens string")
    mined = urlrules.mine(pages.repartition(3), labels, "page_id", "url", "doc_id", F.col("bad") == 1)
    # Against all sets of tokens of the baskets, made by the operator's own choice of tokens.
    tokens = {r["page_id"]: r["t"] for r in pages.select("page_id", urlrules.tokens_of(F.col("url")).alias("t")).collect()}
    part = [(i, b) for i, b in enumerate(bad) if i % 3 and urls[i] is not None]
    total, hits, need = len(part), sum(b for _, b in part), 5
    seen = {}
    for i, b in part:
        for t in tokens[i]:
            n, h = seen.get(t, (0, 0))
            seen[t] = n + 1, h + b
    stray = {t: abs(h * total - n * hits) for t, (n, h) in seen.items() if n >= need}
    baskets = [sorted((t for t in tokens[i] if t in stray), key=lambda t: (-stray[t], t))[:8] for i, _ in part]
    order, rules = plain_rules(baskets, [b for _, b in part], need)
    assert mined.names == [" ".join(p) for p in order] != []
    assert list(zip(mined.rows, mined.blocked)) == [rules[p] for p in order]

    found = urlrules.judge(pages.repartition(4), mined, "page_id", "url", URL_RULES).collect()
    assert sorted(r["page_id"] for r in found) == list(range(len(urls)))
    for row in found:
        url = urls[row["page_id"]]
        host, path = plain_parts(url)
        rule = plain_given(host, path)
        fired = next((p for p in order if set(p) <= set(tokens[row["page_id"]])), None)
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule), url
        assert row["mined_rule"] == (" ".join(fired) if fired else None)
        assert row["verdict"] == (URL_RULES[rule] if rule else "block" if fired else "allow")


def test_url_rules_of_all_tokens(spark, rng):
    """Without a width, rules of tokens that stray little too, of URLs of more tokens than the width."""
    urls, bad = url_rows(rng)
    for i in range(240):  # blocked where two tokens of twelve meet; every other pair of them strays as far
        a, b = i % 2, i // 2 % 2
        urls.append(f"https://w{i % 3}.one.two.three.four.org/five/six/{'seven' if a else 'eight'}/{'nine' if b else 'ten'}?u={i % 5}")
        bad.append(int(a == b))
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame(list(enumerate(bad)), "doc_id long, bad int")
    tokens = {r["page_id"]: r["t"] for r in pages.select("page_id", urlrules.tokens_of(F.col("url")).alias("t")).collect()}
    part = [i for i, u in enumerate(urls) if u is not None]
    n = {}
    for i in part:
        for t in tokens[i]:
            n[t] = n.get(t, 0) + 1
    baskets = [sorted(t for t in tokens[i] if n[t] >= 5) for i in part]
    assert max(map(len, baskets)) > 12
    order, rules = plain_rules(baskets, [bad[i] for i in part], 5)
    mined = urlrules.mine(pages.repartition(3), labels, "page_id", "url", "doc_id", F.col("bad") == 1, width=None)
    assert mined.names == [" ".join(p) for p in order] != []
    assert list(zip(mined.rows, mined.blocked)) == [rules[p] for p in order]
    capped = urlrules.mine(pages, labels, "page_id", "url", "doc_id", F.col("bad") == 1)
    assert capped.names != mined.names


def test_query_mines_all_tokens(spark, tmp_path):
    """Blocked where two tokens meet that stray less alone than eight others of their URL."""
    urls, bad = [], []
    for i in range(480):
        a, b, c = i % 2, i // 2 % 2, i // 4 % 3  # of c, a third is blocked less often: its tokens stray furthest
        names = "/".join(f"{x}{min(c, 1)}" for x in ("o", "p", "q", "r", "s", "t", "u", "v", "w"))
        urls.append(f"https://one.org/{names}/{'seven' if a else 'eight'}/{'nine' if b else 'ten'}")
        bad.append(int(a == b and (c > 0 or i % 8 == 0)))
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([(i, 1 - b, 0) for i, b in enumerate(bad)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    tokens = [["scheme=https", "host=one.org", "label=one", "label=org", *(f"path={w}" for w in u.split("/")[3:])] for u in urls]
    order, rules = plain_rules(tokens, bad, 5)
    first = [next((p for p in order if set(p) <= set(t)), None) for t in tokens]
    found = {r["page_id"]: r for r in QUERIES["op11_url_rules"](spark, str(tmp_path)).collect()}
    assert len(found) == len(urls) and 0 < sum(f is None for f in first) < len(urls)
    for i, rule in enumerate(first):
        assert found[i]["mined_rule"] == (" ".join(rule) if rule else None)
        assert found[i]["verdict"] == ("block" if rule else "allow")
        assert found[i]["mined_confidence"] == (pytest.approx(rules[rule][1] / rules[rule][0]) if rule else None)


def test_tokens(spark):
    row = spark.createDataFrame([("HTTPS://Blog.A.org/En/x-ä_1/x?b=C&b=C&d#Top#2",)], "url string").select(urlrules.tokens_of(F.col("url")).alias("t")).first()
    want = ["scheme=https", "host=blog.a.org", "label=blog", "label=a", "label=org", "path=en", "path=x", "path=ä", "path=1", "query=b=C", "query=d", "fragment=Top#2"]
    assert row["t"] == want


@pytest.mark.parametrize("pages, labels", [([], []), ([(1, "http://a.net/")], []), ([], [(1, 1)]), ([(1, "http://a.com/b")] * 8, [(1, 1)] * 3), ([(None, None)] * 3, [(None, None)] * 3)])
def test_url_rules_of_little(spark, pages, labels):
    rows = spark.createDataFrame(pages, "page_id long, url string")
    mined = urlrules.mine(rows, spark.createDataFrame(labels, "doc_id long, bad int"), "page_id", "url", "doc_id", F.col("bad") == 1)
    found = urlrules.judge(rows, mined, "page_id", "url", URL_RULES).collect()
    assert len(found) == len(pages)
    if len(pages) == 8:  # repeated rows count each
        assert mined.names and all(r["verdict"] == "block" and r["mined_confidence"] == 1.0 for r in found)
    else:
        assert not mined.names
