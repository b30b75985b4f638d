"""WARC archives of web captures, and their index merged into globally ordered capture histories.

Writing: every capture becomes one record, compressed as a gzip member of its own, in WARC 1.1 files of about
ARCHIVE_BYTES. Captures with equal payloads (by SHA-1) of at least MIN_REVISIT bytes are written once, by the one with the
largest page id; the others are revisit records that refer to it.

Reading: every archive is parsed into an index run, sorted by URL key (host reversed), time, page id, file and offset.
Payload lengths and digests of responses are taken from the stored bytes, and a record whose bytes do not match its digest
is an error. Runs are cut at shared range bounds of that whole key, so that a URL with a third of all captures is spread
over ranges, and each range merges its pieces of the runs with a loser tree. A range holds about MERGE_ROWS index rows.

A null html is the empty payload. A null page id is smaller than any other and never what a revisit refers to. Rows
with one page id and payload are each written; if the id is the largest, all of them are responses. A null url has the
empty key. An empty table writes no archive and reads as an empty index. Other columns are not read."""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator, Sequence
from datetime import datetime, timezone
from itertools import accumulate
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.store import durable, new_folder, read_files, write_files

MIN_REVISIT = 1000
ARCHIVE_BYTES, MERGE_ROWS = 8 << 20, 100_000
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format
_RUN = "urlkey string, captured bigint, page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, archive string, offset bigint, length bigint"
_ORDER = ("urlkey", "captured", "page_id", "archive", "offset")


def url_key(url: str | None) -> str:
    """The host's labels in reverse, then path and query, in lower case: pages of a site are neighbours."""
    try:
        parts = urlsplit((url or "").strip())
        host = (parts.hostname or "").removeprefix("www.")
        port = f":{parts.port}" if parts.port not in (None, 80, 443) else ""
    except ValueError:
        return (url or "").lower()
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}{port}){parts.path or '/'}{query}".lower() if host else (url or "").lower()


def classified(pages: DataFrame, captured: Column) -> DataFrame:
    """(page_id, url, html, captured, payload_bytes, payload_digest, latest): ``latest`` is the id a revisit refers to."""
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    captures = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url"), html.alias("html"), captured.cast("bigint").alias("captured"),
        F.octet_length(html).cast("bigint").alias("payload_bytes"), F.sha1(html).alias("payload_digest"),
    )
    repeated = (
        captures.filter(F.col("payload_bytes") >= MIN_REVISIT)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("latest"), F.count("*").alias("n"))
        .filter("n > 1 and latest is not null")
        .select("payload_digest", "latest")
    )
    # stored, so that Spark knows the size: few repeats are broadcast, many are joined by shuffle with hot digests split
    joined = captures.join(durable(repeated), "payload_digest", "left")
    older = F.col("page_id").isNull() | (F.col("page_id") < F.col("latest"))
    return joined.withColumn("latest", F.when(older, F.col("latest")))


def _line(text: str) -> str:
    return text.replace("\r", "%0D").replace("\n", "%0A")


def _date(seconds: int | None) -> str:
    return datetime.fromtimestamp(seconds or 0, timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def record(page_id: int | None, url: str | None, html: bytes, captured: int | None, digest: str, latest: int | None) -> bytes:
    """One WARC record, not compressed."""
    block = _HTTP.encode() + (html if latest is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if latest is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {_date(captured)}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    if latest is not None:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{latest}>", f"X-Payload-Length: {len(html)}"]
    return b"".join(["\r\n".join(head).encode(), b"\r\n\r\n", block, b"\r\n\r\n"])


def write_archives(pages: DataFrame, path: str, captured: Column) -> None:
    """Write a record per row of (page_id, url, html) under ``path``; ``captured`` is the capture's Unix time."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, members, size, chunk = TaskContext.get().partitionId(), [], 0, 0

        def info() -> bytes:
            body = f"software: ledgerloom\r\nformat: WARC File Format 1.1\r\nisPartOf: {part}-{chunk}\r\n"
            head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:archive:{part}-{chunk}>\r\nWARC-Date: {_date(0)}\r\n"
            return gzip.compress(f"{head}Content-Type: application/warc-fields\r\nContent-Length: {len(body)}\r\n\r\n{body}\r\n\r\n".encode(), mtime=0)

        def archive() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"".join([info(), *members])], pa.binary())], ["archive"])

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "html", "captured", "payload_digest", "latest")]
            for i in range(batch.num_rows):
                member = gzip.compress(record(*(c[i].as_py() for c in columns)), 4, mtime=0)
                members.append(member)
                size += len(member)
                if size >= ARCHIVE_BYTES:
                    yield archive()
                    members, size, chunk = [], 0, chunk + 1
        if members:
            yield archive()

    rows = classified(pages, captured).select("page_id", "url", "html", "captured", "payload_digest", "latest")
    write_files(rows.mapInArrow(pack, "archive binary"), path)


def members(content: memoryview, step: int = 1 << 16) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, data) of the gzip members of an archive; the bytes are fed piece by piece."""
    at = 0
    while at < len(content) and content[at] != 0:
        unzip, out, start = zlib.decompressobj(31), [], at
        while not unzip.eof:
            if at >= len(content):
                raise ValueError("the archive ends within a record")
            piece = content[at : at + step]
            out.append(unzip.decompress(piece))
            at += len(piece) - len(unzip.unused_data)
        yield start, at - start, b"".join(out)


def _id(value: str | None) -> int | None:
    digits = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def parse(data: bytes) -> dict | None:
    """The index fields of one record; None for a warcinfo record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    if fields["WARC-Type"] == "warcinfo":
        return None
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    response = fields["WARC-Type"] == "response"
    if response and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    url = fields.get("WARC-Target-URI")
    return {
        "urlkey": url_key(url), "captured": int(datetime.fromisoformat(fields["WARC-Date"]).timestamp()), "page_id": _id(fields["WARC-Record-ID"]),
        "url": url, "record_type": fields["WARC-Type"], "refers_to": _id(fields.get("WARC-Refers-To")), "payload_digest": digest,
        "payload_bytes": len(payload) if response else int(fields["X-Payload-Length"]),
    }


def _key(row: dict | Sequence) -> tuple:
    urlkey, captured, page_id, archive, offset = (row[k] for k in _ORDER) if isinstance(row, dict) else row
    return (urlkey, captured, page_id is not None, page_id or 0, archive, offset)


_SCHEMA = pa.schema([(n, pa.string() if t == "string" else pa.int64()) for n, t in (x.split() for x in _RUN.split(", "))])


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """One sorted index run per archive, stored."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                run = []
                for offset, length, data in members(memoryview(content.as_buffer())):
                    fields = parse(data)
                    if fields:
                        run.append(fields | {"archive": name.rsplit("/", 1)[-1], "offset": offset, "length": length})
                yield pa.RecordBatch.from_pylist(sorted(run, key=_key), _SCHEMA)

    return durable(read_files(spark, path).mapInArrow(index, _RUN))


class LoserTree:
    """Merge of k sorted sequences: an inner node keeps the loser of its match, the overall winner is on top, and after
    each step only the path of the winner's leaf is played again."""

    def __init__(self, runs: Sequence[Sequence]):
        self.runs, self.next, self.k = runs, [0] * len(runs), len(runs)
        self.losers = [-1] * max(1, self.k)
        self.top = self._play(1) if self.k > 1 else 0

    def _head(self, i: int):
        return self.runs[i][self.next[i]] if self.next[i] < len(self.runs[i]) else None

    def _wins(self, a: int, b: int) -> bool:
        x, y = self._head(a), self._head(b)
        return y is None or (x is not None and (x, a) <= (y, b))

    def _play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        winner, self.losers[node] = (a, b) if self._wins(a, b) else (b, a)
        return winner

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """(run, place in it) in the merged order."""
        while self.k and self._head(self.top) is not None:
            i = self.top
            yield i, self.next[i]
            self.next[i] += 1
            node = (i + self.k) // 2
            while node:
                if self._wins(self.losers[node], i):
                    self.losers[node], i = i, self.losers[node]
                node //= 2
            self.top = i


def merged(runs: DataFrame, rows_per_range: int = MERGE_ROWS) -> DataFrame:
    """The runs in one global order: rows with (range, position), each range later than the one before."""
    ranges = max(int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-runs.count() // rows_per_range))
    order = [F.col(c).asc_nulls_first() for c in _ORDER]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), _SCHEMA).combine_chunks()
        if not table.num_rows:
            return
        keys = [_key(k) for k in zip(*(table.column(c).to_pylist() for c in _ORDER))]
        names = table.column("archive").to_pylist()
        cuts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
        tree = LoserTree([keys[a:b] for a, b in zip(cuts, cuts[1:])])
        out = table.take(pa.array([cuts[run] + i for run, i in tree], pa.int64()))
        part = pa.array([TaskContext.get().partitionId()] * table.num_rows, pa.int64())
        out = out.append_column("range", part).append_column("position", pa.array(range(table.num_rows), pa.int64()))
        yield from out.combine_chunks().to_batches()

    # within a range, each run's piece is in the run's own order
    placed = runs.repartitionByRange(ranges, *order).sortWithinPartitions(F.col("archive"), *order)
    return placed.mapInArrow(merge, f"{_RUN}, range bigint, position bigint")


def in_order(history: DataFrame) -> DataFrame:
    """The merged history with ``place``, each capture's number in the global order from 0; stored."""
    rows = durable(history)
    # one count per range goes to the driver
    sizes = {r["range"]: r["n"] for r in rows.groupBy("range").agg(F.count("*").alias("n")).collect()}
    before = list(accumulate([0, *(sizes.get(i, 0) for i in range(max(sizes, default=0) + 1))]))
    offset = F.get(F.array(*[F.lit(b).cast("bigint") for b in before]), F.col("range").cast("int"))
    return rows.withColumn("place", offset + F.col("position")).drop("range", "position")


def op2_warc(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    path = new_folder(spark, "warc")
    # the table has no capture time: one page a second in the order of ids
    write_archives(pages, path, F.lit(1_704_067_200) + F.pmod(F.coalesce(F.col("page_id"), F.lit(0)), F.lit(1 << 30)))
    history = in_order(merged(read_runs(spark, path)))
    return history.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "captured", "place")


WARC_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, 1704067200 + coalesce(page_id, 0) % 1073741824 AS captured,
         regexp_extract(trim(coalesce(url, '')), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::([0-9]*))?([^?#]*)(\?[^#]*)?', ['host', 'port', 'path', 'query']) AS u, url
  FROM pages
), k AS (
  SELECT page_id, html, captured, lower(CASE WHEN u.host = '' THEN coalesce(url, '') ELSE
           array_to_string(list_reverse(string_split(regexp_replace(lower(u.host), '^www\.', ''), '.')), ',') || CASE WHEN u.port IN ('', '80', '443') THEN '' ELSE ':' || u.port END
           || ')' || CASE WHEN u.path = '' THEN '/' ELSE u.path END || CASE WHEN u.query IN ('', '?') THEN '' ELSE u.query END END) AS urlkey FROM p
), d AS (
  SELECT page_id, urlkey, captured, octet_length(encode(html)) AS payload_bytes, sha1(html) AS payload_digest,
         row_number() OVER (ORDER BY urlkey, captured, page_id NULLS FIRST) - 1 AS place FROM k
), latest AS (
  SELECT payload_digest, max(page_id) AS top FROM d WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, d.payload_digest AS payload_digest,
       CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id < top THEN top END AS refers_to, urlkey, captured::BIGINT AS captured, place
FROM d LEFT JOIN latest ON d.payload_digest = latest.payload_digest
"""


QUERIES = {"op2_warc": op2_warc}
ORACLE_SQL = {"op2_warc": WARC_SQL}
