"""Packing of documents into fixed windows by minimum bin slack.

A document is its token ids and a final 0. Full windows of ``capacity`` ids fill a
sequence each; the remaining lengths, all below the capacity, are packed.

The packing works on the number of pieces of each length, at most ``capacity - 1``
numbers however large the corpus. The longest remaining length opens a window, a
bitset subset-sum over the other lengths and their counts finds the fill closest
to the capacity, and walking back through the bitsets gives how many pieces of
each length it takes. The fill is repeated while the counts last, so every step
uses up a length.

Pieces are numbered within their length by task and place in the task (from a
written table, so a repeated task sees the same numbers); the number says which
window and offset a piece has. Nothing is sorted globally or collected but the
counts. A null or empty text is one piece, the final 0; a text of any length is cut into
full windows and a rest. Pieces of one length are alike, so their order settles ties.
Rows that repeat an id are packed one by one. An empty table gives an empty result. Only
the id and the text are read. Words are recognised by a 64-bit hash within a task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from stationflow.llm.staging import staged, text_bytes
from stationflow.llm.tokens import SLICE_BYTES, byte_hashes, slices

_BLANK = 0x20
#: Kinds of bytes beside a blank that make it the begin of a piece of its own.
_PLAIN = np.zeros(256, bool)
_PLAIN[0x21:0x7F] = True
_LETTER_LEAD = 0xC3  # two-byte Latin letters
_KNOWN = 1 << 19
#: Fixed value: the pattern that splits text before the merges of byte-level vocabularies.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded_length), a row for each piece."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), text_bytes(F.col(text_col)).alias("_bytes"))
    cut = rows.mapInArrow(lambda batches: _pieces(batches, tokenizer, capacity), f"_id {kind}, start long, length int, ids_crc32 long, doc_tokens long, task int, number long")
    pieces = staged(cut, "pieces")
    by_task = pieces.groupBy("length", "task").agg((F.max("number") + 1).alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    counts.pop(capacity, None)
    plan = Plan(minimum_slack(counts, capacity), capacity)
    placed = pieces.join(offsets, ["length", "task"]).select("_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("number")).alias("rank"))
    out = placed.mapInArrow(lambda batches: _placed(batches, plan), f"_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded_length long")
    return out.withColumnRenamed("_id", id_col)


def minimum_slack(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """([length: pieces of it], windows filled so) until every piece has its place."""
    left = {n: c for n, c in counts.items() if c > 0}
    out = []
    while left:
        first = max(left)
        fill = {first: 1}
        left[first] -= 1
        for n, c in _closest(left, capacity - first).items():
            fill[n] = fill.get(n, 0) + c
        left[first] += 1
        times = min(left[n] // c for n, c in fill.items())
        for n, c in fill.items():
            left[n] -= c * times
            if not left[n]:
                del left[n]
        out.append((fill, times))
    return out


def _closest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The pieces whose lengths come closest to ``room`` from below."""
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for n in sorted((n for n in counts if n <= room), reverse=True):
        most = min(counts[n], room // n)
        if not most:
            continue
        steps.append((n, most, reach))
        left, size = most, 1
        while left:
            take = min(size, left)
            reach |= (reach << (n * take)) & mask
            left -= take
            size *= 2
        if reach >> room & 1:
            break
    total, out = reach.bit_length() - 1, {}
    for n, most, before in reversed(steps):
        used = next(m for m in range(most + 1) if total >= m * n and before >> (total - m * n) & 1)
        if used:
            out[n] = used
            total -= used * n
    return out


class Plan:
    """Where the pieces of each length go, by their rank in the length."""

    def __init__(self, fills: list[tuple[dict[int, int], int]], capacity: int):
        self.capacity = capacity
        keys, taken, sequence = [], {}, 0
        for fill, times in fills:
            offset, total = 0, sum(n * c for n, c in fill.items())
            for n, c in fill.items():
                begin = taken.get(n, 0)
                keys.append((n, begin, c, offset, sequence, total))
                taken[n] = begin + c * times
                offset += n * c
            sequence += times
        self.sequences = sequence
        self.table = np.array(sorted(keys), np.int64).reshape(-1, 6)

    def place(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sequence, offset and ids of the sequence, for each piece."""
        full = lengths == self.capacity
        sequence, offset, total = self.sequences + ranks, np.zeros_like(ranks), lengths.copy()
        at = np.flatnonzero(~full)
        if len(at):
            own = self.table[:, 0] << 44 | self.table[:, 1]
            row = self.table[np.searchsorted(own, lengths[at] << 44 | ranks[at], "right") - 1]
            nth = ranks[at] - row[:, 1]
            sequence[at] = row[:, 4] + nth // row[:, 2]
            offset[at] = row[:, 3] + nth % row[:, 2] * lengths[at]
            total[at] = row[:, 5]
        return sequence, offset, total


def _signs() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else the next free one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in printable}
    for n, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + n)
    return out


class Encoder:
    """Token ids of many texts; what stands between single blanks is encoded once.

    A blank with a plain sign or Latin letter on both sides begins a new match of
    the tokenizer's pattern whatever stands around, so the text may be cut there.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        signs = {sign: byte for byte, sign in _signs().items()}
        vocabulary = {token: i for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if token not in self.special}
        ranks = {bytes(signs[c] for c in token): i for token, i in vocabulary.items()}
        self.ranked = tiktoken.Encoding(path, pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.hashes, self.first = np.zeros(0, np.uint64), np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def encode(self, data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text begins in it."""
        starts = self._cuts(data, places)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(places), np.int64)
        ends = np.append(starts[1:], len(data))
        unique, where, back = np.unique(byte_hashes(data, starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, unique)
        known = np.zeros(len(unique), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == unique[inside]
        new = np.flatnonzero(~known)
        raw = data.tobytes()
        texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[where[new]].tolist(), ends[where[new]].tolist(), strict=True)]
        found = self._ids(texts, [s for s in self.special if s.encode() in raw])
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        added = np.fromiter(chain.from_iterable(found), np.uint32, sizes.sum())
        flat = np.concatenate([self.ids, added])
        begin, size = np.empty(len(unique), np.int64), np.empty(len(unique), np.int64)
        begin[known], size[known] = self.first[:-1][at[known]], np.diff(self.first)[at[known]]
        begin[new], size[new] = len(self.ids) + np.cumsum(sizes) - sizes, sizes
        counts = size[back]
        to = np.cumsum(counts)
        ids = flat[np.repeat(begin[back] - (to - counts), counts) + np.arange(to[-1])]
        total = np.concatenate([[0], to])[np.searchsorted(starts, places)]
        self._remember(unique[new], sizes, added)
        return ids, total

    def _cuts(self, data: np.ndarray, places: np.ndarray) -> np.ndarray:
        blank = np.flatnonzero(data == _BLANK)
        blank = blank[(blank > 1) & (blank < len(data) - 1)]
        after = _PLAIN[data[blank + 1]] | (data[blank + 1] == _LETTER_LEAD)
        before = _PLAIN[data[blank - 1]] | ((data[blank - 1] >= 0x80) & (data[blank - 2] == _LETTER_LEAD))
        begins = places[:-1][np.diff(places) > 0]
        cut = np.zeros(len(data), bool)
        cut[blank[after & before]] = True
        cut[begins] = True
        return np.flatnonzero(cut)

    def _ids(self, texts: list[str], special: list[str]) -> list[list[int]]:
        """Single words cost the first library a multiple of their merges, so the second one merges them."""
        out = [self.ranked.encode_ordinary(x) for x in texts]
        if special:
            for i, x in enumerate(texts):
                if any(s in x for s in special):
                    out[i] = self.tokenizer.encode(x, add_special_tokens=False).ids
        return out

    def _remember(self, hashes: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Keep what is new while there is room."""
        room = _KNOWN - len(self.hashes)
        if room <= 0 or not len(hashes):
            return
        hashes, sizes = hashes[:room], sizes[:room]
        every = np.concatenate([self.hashes, hashes])
        order = np.argsort(every)
        begin = np.concatenate([self.first[:-1], len(self.ids) + np.cumsum(sizes) - sizes])[order]
        flat, sizes = np.concatenate([self.ids, ids]), np.concatenate([np.diff(self.first), sizes])[order]
        first = np.concatenate([[0], np.cumsum(sizes)])
        self.ids = flat[np.repeat(begin - first[:-1], sizes) + np.arange(first[-1])]
        self.hashes, self.first = every[order], first


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int) -> Iterator[pa.RecordBatch]:
    encoder, task = _encoder(path), TaskContext.get().partitionId()
    numbers = np.zeros(capacity + 1, np.int64)
    for batch in batches:
        for rows, places, data in slices(batch["_bytes"], 4 * SLICE_BYTES):
            ids, first = encoder.encode(data, places)
            doc, start, length, crc, total = [], [], [], [], []
            for d, row in enumerate(rows):
                own = np.append(ids[first[d] : first[d + 1]], 0).astype("<u4")
                for at in range(0, len(own), capacity):
                    piece = own[at : at + capacity]
                    doc.append(row)
                    start.append(at)
                    length.append(len(piece))
                    crc.append(zlib.crc32(piece.tobytes()))
                    total.append(len(own))
            lengths = np.array(length, np.int64)
            order = np.argsort(lengths, kind="stable")
            group = lengths[order]
            new = np.flatnonzero(np.diff(group, prepend=-1))
            sizes = np.diff(np.append(new, len(group)))
            number = np.empty(len(group), np.int64)
            number[order] = np.arange(len(group)) - np.repeat(new, sizes) + numbers[group]
            numbers[group[new]] += sizes
            yield pa.RecordBatch.from_arrays(
                [batch["_id"].take(pa.array(doc, pa.int64())), pa.array(start, pa.int64()), pa.array(lengths.astype(np.int32)), pa.array(crc, pa.int64()), pa.array(total, pa.int64()), pa.array(np.full(len(doc), task, np.int32)), pa.array(number)],
                names=["_id", "start", "length", "ids_crc32", "doc_tokens", "task", "number"],
            )


def _placed(batches: Iterator[pa.RecordBatch], plan: Plan) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths = batch["length"].to_numpy().astype(np.int64)
        sequence, offset, total = plan.place(lengths, batch["rank"].to_numpy())
        padded = np.where(total & (total - 1) == 0, total, plan.capacity)
        yield pa.RecordBatch.from_arrays(
            [batch["_id"], batch["start"], pa.array(lengths), batch["ids_crc32"], batch["doc_tokens"], pa.array(sequence), pa.array(offset), pa.array(padded)],
            names=["_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded_length"],
        )
