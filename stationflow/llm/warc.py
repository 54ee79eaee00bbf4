"""WARC archives of pages, read back through an external index merge.

Writing: one record a page. Of pages with equal payloads of at least ``revisit_bytes``
the one with the largest id is the response, the others are revisits of it; which
that is comes from a count by digest, combined before the shuffle. Each archive is a
row of at most about ``archive_bytes`` of records, every record a gzip member of its
own, and Spark's text writer puts each row into a file: its commit protocol covers
lost executors, and any file system that Spark writes will do. The zero byte that
ends such a row is padding to gzip readers.

Reading: every archive gives a run of index entries, sorted by URL key, timestamp
and page. The runs are dealt by ranges of that key, one task a range, and a loser
tree merges the parts of the runs there: k runs cost log k comparisons an entry. Ranges
follow each other, so the result is one capture history in order. Their number
grows with the entries, and the run is part of the range key, so a URL with a third
of all captures is spread over ranges.

A null payload is empty. A null URL has the empty key. Pages without id are written
without it. Equal payloads under one id are all responses, so repeated rows are too.
Payloads of any length are one record each. An empty table gives no
archive and an empty result. Other columns are left out.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator, Sequence
from datetime import datetime, timezone
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stationflow.llm.staging import staged, text_bytes
from stationflow.operators.skew import one_per_key

REVISIT_BYTES, ARCHIVE_BYTES, RANGE_ROWS = 1000, 16 << 20, 1_000_000
_ENTRY = "run string, place long, url_key string, captured long, page_id {id}, payload_bytes long, payload_digest string, record_type string, refers_to {id}, record_offset long, record_length long"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_FIRST_CAPTURE = 1_704_067_200  # 2024-01-01, for pages without a time of their own


def write_archives(pages: DataFrame, folder: str, captured: Column | None = None, revisit_bytes: int = REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write ``pages`` (page_id, url, html) as WARC files. ``captured`` is in seconds; by default the page id after 2024-01-01."""
    captured = F.lit(_FIRST_CAPTURE) + F.coalesce(F.pmod(F.col("page_id").cast("long"), F.lit(1 << 31)), F.lit(0)) if captured is None else captured
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), text_bytes(F.col("html")).alias("payload"), captured.cast("long").alias("captured"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    large = rows.filter(F.length("payload") >= revisit_bytes)
    first = one_per_key(large, ["digest"], F.max("page_id").alias("response"), F.count("*").alias("n")).filter("n > 1").select("digest", "response")
    marked = rows.join(first, "digest", "left").withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("response")), F.col("response")))
    marked = marked.select("page_id", "url", "payload", "captured", "digest", "refers_to")
    archives = marked.mapInArrow(lambda batches: _archives(batches, archive_bytes), "archive binary")
    archives.select(F.col("archive").cast("string")).write.option("maxRecordsPerFile", 1).option("lineSep", "\0").text(folder)


def read_runs(spark: SparkSession, folder: str, id_type: str = "bigint") -> DataFrame:
    """The index entries of every archive, each archive a sorted run. Digests are checked."""
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return files.mapInArrow(lambda batches: _runs(batches, id_type), _ENTRY.format(id=id_type))


def read_payloads(spark: SparkSession, folder: str, id_type: str = "bigint") -> DataFrame:
    """(page_id, url, payload) of every response."""
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return files.mapInArrow(lambda batches: _payloads(batches, id_type), f"page_id {id_type}, url string, payload binary")


def merged_index(runs: DataFrame) -> DataFrame:
    """The entries of all runs, ordered by URL key, timestamp and page."""
    runs = staged(runs, "runs")
    ranges = max(int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")), runs.count() // RANGE_ROWS + 1)
    dealt = runs.repartitionByRange(ranges, "url_key", "captured", "page_id", "run", "place").sortWithinPartitions("run", "place")
    return dealt.mapInArrow(_merge, runs.schema)


def _archives(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    records, size = [], 0
    for batch in batches:
        for row in batch.to_pylist():
            records.append(zlib.compress(_record(**row), 3, 31))
            size += len(row["payload"])
            if size >= most:
                yield pa.RecordBatch.from_pydict({"archive": pa.array([b"".join(records)], pa.binary())})
                records, size = [], 0
    if records:
        yield pa.RecordBatch.from_pydict({"archive": pa.array([b"".join(records)], pa.binary())})


def _urn(page_id: object, digest: str, url: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest} {url}' if page_id is None else f'page {page_id} {digest}')}>"


def _record(page_id: object, url: str | None, payload: bytes, captured: int | None, digest: str, refers_to: object) -> bytes:
    url = quote(url or "", safe="!#$%&'()*+,/:;=?@[]~")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_urn(page_id, digest, url)}",
        f"WARC-Target-URI: {url}",
        f"WARC-Date: {datetime.fromtimestamp(captured or 0, timezone.utc):%Y-%m-%dT%H:%M:%SZ}",
        f"WARC-Payload-Digest: sha1:{digest}",
        *([] if page_id is None else [f"X-Page-Id: {page_id}"]),
        *([] if refers_to is None else [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_urn(refers_to, digest, '')}", f"X-Refers-To-Page: {refers_to}"]),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _members(content: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, record) of each gzip member; zero bytes between members are padding."""
    view, at = memoryview(content), 0
    while at < len(view):
        if view[at] == 0:
            at += 1
            continue
        member, parts, to = zlib.decompressobj(31), [], at
        while not member.eof:
            if to >= len(view):
                raise ValueError("an archive ends within a record")
            parts.append(member.decompress(view[to : to + (1 << 16)]))
            to += min(1 << 16, len(view) - to)
        to -= len(member.unused_data)
        yield at, to - at, b"".join(parts)
        at = to


def _headers(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, rest


def _parsed(content: bytes) -> Iterator[tuple[int, int, dict[str, str], int, bytes | None]]:
    """(offset, length, WARC fields, payload's length, payload unless revisit)."""
    for offset, length, record in _members(content):
        fields, rest = _headers(record)
        block = rest[: int(fields["Content-Length"])]
        if rest[len(block) :] != b"\r\n\r\n":
            raise ValueError(f"record {fields['WARC-Record-ID']} has a wrong length")
        http, payload = _headers(block)
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        revisit = fields["WARC-Type"] == "revisit"
        if not revisit and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != int(http["Content-Length"])):
            raise ValueError(f"record {fields['WARC-Record-ID']} does not match its digest")
        yield offset, length, fields, int(http["Content-Length"]), None if revisit else payload


def url_key(url: str) -> str:
    """Host labels from the last to the first, then path and query, in lower case, without ``www``, port and fragment."""
    try:
        parts = urlsplit(url.strip().lower())
        host = parts.hostname or ""
    except ValueError:
        return url.lower()
    if not host:
        return url.lower()
    labels = re.sub(r"^www\d*\.", "", host).split(".")
    return ",".join(reversed(labels)) + ")" + (parts.path or "/") + ("?" + parts.query if parts.query else "")


def _id(text: str | None, kind: str) -> object:
    return text if text is None or kind == "string" else int(text)


def _order(entry: dict) -> tuple:
    return entry["url_key"], entry["captured"], entry["page_id"] is not None, entry["page_id"]


def _runs(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file in batch.to_pylist():
            entries = []
            for offset, length, fields, size, _ in _parsed(file["content"]):
                date = datetime.strptime(fields["WARC-Date"], "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=timezone.utc)
                entries.append(
                    {
                        "run": file["path"],
                        "url_key": url_key(fields["WARC-Target-URI"]),
                        "captured": int(date.timestamp()),
                        "page_id": _id(fields.get("X-Page-Id"), kind),
                        "payload_bytes": size,
                        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                        "record_type": fields["WARC-Type"],
                        "refers_to": _id(fields.get("X-Refers-To-Page"), kind),
                        "record_offset": offset,
                        "record_length": length,
                    }
                )
            entries.sort(key=_order)
            for place, entry in enumerate(entries):
                entry["place"] = place
            if entries:
                yield pa.RecordBatch.from_pylist(entries, schema=_arrow(kind))


def _arrow(kind: str) -> pa.Schema:
    number = {"string": pa.string(), "int": pa.int32()}.get(kind, pa.int64())
    kinds = {"long": pa.int64(), "string": pa.string(), "{id}": number}
    return pa.schema([(name, kinds[type_]) for name, type_ in (x.split() for x in _ENTRY.split(", "))])


def _payloads(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file in batch.to_pylist():
            for _, _, fields, _, payload in _parsed(file["content"]):
                if payload is not None:
                    yield pa.RecordBatch.from_pydict({"page_id": pa.array([_id(fields.get("X-Page-Id"), kind)], _arrow(kind).field("page_id").type), "url": [fields["WARC-Target-URI"]], "payload": pa.array([payload], pa.binary())})


def loser_tree(runs: Sequence[Sequence[tuple]]) -> Iterator[tuple[int, int]]:
    """(run, place) of the items of sorted runs in order; equal items in the order of the runs.

    Every inner node keeps the loser of its match, so after the champion has moved
    on only the nodes on its way to the root are played again.
    """
    k, place = len(runs), [0] * len(runs)

    def before(a: int, b: int) -> bool:
        if place[a] == len(runs[a]) or place[b] == len(runs[b]):
            return place[a] < len(runs[a])
        return (runs[a][place[a]], a) < (runs[b][place[b]], b)

    losers: list[int | None] = [None] * k
    champion = 0
    for run in range(k):
        player, node = run, (run + k) // 2
        while node and losers[node] is not None:
            if before(losers[node], player):
                losers[node], player = player, losers[node]
            node //= 2
        if node:
            losers[node] = player
        else:
            champion = player
    while k and place[champion] < len(runs[champion]):
        yield champion, place[champion]
        place[champion] += 1
        player, node = champion, (champion + k) // 2
        while node:
            if before(losers[node], player):
                losers[node], player = player, losers[node]
            node //= 2
        champion = player


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The entries of one range: parts of runs, one after the other, merged."""
    table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
    if table is None or not table.num_rows:
        return
    keys = [_order(x) for x in table.select(["url_key", "captured", "page_id"]).to_pylist()]
    names = table["run"].to_pylist()
    begins = [i for i in range(len(names)) if i == 0 or names[i] != names[i - 1]]
    runs = [keys[a:b] for a, b in zip(begins, [*begins[1:], len(keys)], strict=True)]
    order = [begins[run] + place for run, place in loser_tree(runs)]
    yield from table.take(pa.array(order, pa.int64())).to_batches()
