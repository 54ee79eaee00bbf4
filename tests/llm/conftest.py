import os
import random
import sys

import pytest

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, _ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])  # for the workers

#: Words drawn with uneven frequencies, so that short runs repeat by chance.
VOCABULARY = [a + b for a in ("on", "ra", "Ti", "el", "us") for b in ("da", "mo", "ré", "k", "sst", "en", "y")]


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(VOCABULARY[: rng.choice((5, 20, len(VOCABULARY)))]) for _ in range(n))


@pytest.fixture
def rng():
    return random.Random(11)


@pytest.fixture(scope="session")
def odd_rows():
    """Documents of every awkward kind, with columns whose names clash with those of the operators."""
    rng = random.Random(5)
    passage, base = sentence(rng, 60), sentence(rng, 120)
    words = base.split()
    near = [" ".join([*words[:k], "changed", *words[k + 1 :]]) for k in (3, 60, 110)]
    texts = [
        None, "", " \t\n", "one", "one two", base, base, *near, sentence(rng, 30) + " " + passage,
        passage + "\n" + sentence(rng, 40), "again " * 200, sentence(rng, 30_000), sentence(rng, 25), " nbsp\x0bform\x0cfeed",
        " ".join(reversed(near[0].split())), passage.upper(),
    ]
    rows = [(i, t, "en" if i % 2 else None, "src0" if i % 3 else None, None if t is None else len(t)) for i, t in enumerate(texts)]
    return [*rows, (5, base, None, "src0", len(base)), (None, base, "en", "src1", len(base)), (None, None, None, None, None)]


@pytest.fixture
def odd(spark, odd_rows):
    docs = spark.createDataFrame(odd_rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.selectExpr("*", "'x' AS _key", "1 AS node", "2 AS n", "3 AS component", "4 AS token", "5 AS kept", "6 AS score")


@pytest.fixture
def empty(odd):
    return odd.limit(0)
