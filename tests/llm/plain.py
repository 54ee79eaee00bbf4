"""Brute-force versions of the operators, for small inputs."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import pyarrow as pa


def words(text: str | None, lower: bool = False) -> list[bytes]:
    raw = (text or "").encode()
    return (bytes(c + 32 if 65 <= c <= 90 else c for c in raw) if lower else raw).split()


def kept_words(texts: list[str | None], length: int) -> list[tuple[int, list[bytes]]]:
    """(words, kept words) of each text without every window that occurs twice."""
    every = [words(t) for t in texts]
    count = Counter(tuple(w[i : i + length]) for w in every for i in range(len(w) - length + 1))
    out = []
    for w in every:
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if count[tuple(w[i : i + length])] > 1:
                gone[i : i + length] = [True] * length
        out.append((len(w), [x for x, g in zip(w, gone, strict=True) if not g]))
    return out


def shingle_set(text: str | None, n: int) -> frozenset:
    w = words(text, lower=True)
    if len(w) < n:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def components(size: int, links: list[tuple[int, int]]) -> list[list[int]]:
    """For each place the places it reaches."""
    parent = list(range(size))

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[root(a)] = root(b)
    groups = defaultdict(list)
    for x in range(size):
        groups[root(x)].append(x)
    return [groups[root(x)] for x in range(size)]


def jaccard_links(texts: list[str | None], n: int, share: int) -> list[tuple[int, int]]:
    sets = [shingle_set(t, n) for t in texts]
    return [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if a and b and 100 * len(a & b) >= share * len(a | b)]


def least(ids: list, group: list[int]) -> object:
    return min((ids[x] for x in group if ids[x] is not None), default=None)


def tiled(item: list[bytes], doc: list[bytes], k: int) -> int:
    """Words covered by greedy string tiling, by comparing everything with everything."""
    marked_i, marked_d, total = [False] * len(item), [False] * len(doc), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while i + n < len(item) and d + n < len(doc) and item[i + n] == doc[d + n] and not marked_i[i + n] and not marked_d[d + n]:
                    n += 1
                best = max(best, (n, -d, -i))
        n, d, i = best[0], -best[1], -best[2]
        if n < k:
            return total
        marked_i[i : i + n] = marked_d[d : d + n] = [True] * n
        total += n


def base_scores(ids: list, texts: list[str | None]) -> list[tuple[bool, int, int, int, float]]:
    """(held out, tokens, known tokens, training tokens, add-one log10 probability)."""
    tokens = [[*words(t, lower=True), None] for t in texts]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i in ids]
    count = Counter(x for t, h in zip(tokens, held, strict=True) if not h for x in t)
    total, distinct = sum(count.values()), len(count)
    return [(h, len(t), sum(count[x] > 0 for x in t), total, sum(math.log10((count[x] + 1) / (total + distinct + 1)) for x in t)) for h, t in zip(held, tokens, strict=True)]


def cut_lines(rows: list[tuple], ratio: float, least: int) -> list[tuple]:
    """(id, text, host) with the lines that more than ``ratio`` of a host's pages hold taken out."""
    pages, holding = Counter(h for _, _, h in rows if h is not None), Counter()
    for _, text, host in rows:
        if host is not None and text is not None:
            holding.update((host, line) for line in set(text.split("\n")) - {""})
    gone = {x for x, n in holding.items() if n >= least and n > ratio * pages[x[0]]}
    return [(i, text if text is None else "\n".join(x for x in text.split("\n") if (host, x) not in gone), host) for i, text, host in rows]


def suffix_tree(training: list[list], least_count: int, least_gain: float, discount: float = 0.75):
    """(predict, vocabulary, states): the tree of lists of words that end with None."""
    count = Counter(x for t in training for x in t)
    total, distinct = sum(count.values()), len(count)
    following: dict[tuple, Counter] = defaultdict(Counter)
    longest = max(map(len, training), default=0)

    def root(word: object) -> float:
        return (count[word] + 1) / (total + distinct + 1)

    def own(context: tuple, word: object, shorter: float) -> float:
        next_ = following[context]
        n = sum(next_.values())
        return max(next_[word] - discount, 0) / n + discount * len(next_) / n * shorter

    passed: set[tuple] = set()

    def tested(context: tuple, word: object) -> float:
        """The prediction while the tree grows: contexts that passed count, their suffixes may not."""
        if not context:
            return root(word)
        shorter = tested(context[1:], word)
        return own(context, word, shorter) if context in passed else shorter

    for n in range(1, longest):
        for t in training:
            for i in range(n, len(t)):
                following[tuple(t[i - n : i])][t[i]] += 1
        level = set()
        for context in [c for c in following if len(c) == n and sum(following[c].values()) >= least_count]:
            gain = 0.0
            for word, times in following[context].items():
                shorter = tested(context[1:], word)
                gain += times * math.log(own(context, word, shorter) / shorter)
            if gain >= least_gain * sum(following[context].values()):
                level.add(context)
        if not level:
            break
        passed |= level
    states = {c[i:] for c in passed for i in range(len(c))}

    def predict(context: tuple, word: object) -> float:
        return own(context, word, predict(context[1:], word)) if context else root(word)

    return predict, set(count), states


def suffix_tree_scores(texts: list[str | None], held: list[bool], least_count: int, least_gain: float) -> tuple[list[float], int]:
    """log10 probability of each text, and the length of the longest state."""
    tokens = [[*words(t, lower=True), None] for t in texts]
    predict, _, states = suffix_tree([t for t, h in zip(tokens, held, strict=True) if not h], least_count, least_gain)
    longest = max(map(len, states), default=0)
    out = []
    for t in tokens:
        score = 0.0
        for i, word in enumerate(t):
            context = tuple(t[max(0, i - longest) : i])
            while context and context not in states:
                context = context[1:]
            score += math.log10(predict(context, word))
        out.append(score)
    return out, longest


def convolved(model: object, toxicity: object, text: bytes) -> float:
    """The score of a text by a model: one place, one filter and one component at a time."""
    size = model.embeddings.shape[1]
    vectors = []
    for word in text.lower().split():
        (own,) = toxicity.words(pa.array([word], pa.binary()), lower=True)
        vectors.append([sum(float(model.embeddings[b][c]) for b in toxicity._buckets(own)[0]) for c in range(size)])
    places = max(len(vectors), 1)
    vectors += [[0.0] * size] * (places + max(toxicity.WIDTHS) - len(vectors))
    logit, at = model.bias, 0
    for width, filters, biases in zip(toxicity.WIDTHS, model.filters, model.biases, strict=True):
        for f in range(len(biases)):
            best = max(sum(vectors[i + j][c] * float(filters[j * size + c][f]) for j in range(width) for c in range(size)) + float(biases[f]) for i in range(places))
            logit += max(best, 0.0) * float(model.weights[at])
            at += 1
    return 1 / (1 + math.exp(-logit))
