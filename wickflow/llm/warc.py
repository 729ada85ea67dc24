"""Operator 6: WARC archives with an externally merged capture index.

Each task sorts its pages by URL key, time and id, writes them as gzip members of
archives (about ``ARCHIVE_BYTES`` each) and, beside them, the index of what it wrote: a
sorted run, in blocks. The runs are then merged externally: blocks are cut at range
boundaries of (key, time, id), every range gathers its pieces of all runs, and a loser
tree merges them, one comparison per level for each entry. Ranges follow each other, so
the capture histories are ordered globally. A hot URL key spreads over several ranges.

Archives and runs are one Parquet table (columns kind, name, data, entries), committed by
Spark, so a lost task is written again and the store need not be a local folder.

Records with equal payloads (SHA-1) of at least ``REVISIT_BYTES`` are stored once: the
one with the largest id is the response, the others are revisits without a payload.
Which digests repeat is found by an aggregate with partial sums.

Edge cases: a null payload is empty; a null URL has the empty key. Ids may be null: such
records sort first and never are the response of others; if a whole group has null ids,
all are responses. Rows that repeat the largest id are all responses. An empty table
gives empty archives. Columns other than id, URL and payload are not read.

Bounds: boundaries come from a sample of ``SAMPLE_PER_RANGE`` keys per range, with at
most ``RANGES`` ranges of about ``RANGE_ENTRIES`` entries; beyond their product (four
billion records) a range's memory grows in proportion.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickflow.llm.urlrules import LOWER, UPPER
from wickflow.session import scratch_path

ARCHIVE_BYTES = 4 << 20
REVISIT_BYTES = 1000
BLOCK_ENTRIES = 4096
RANGE_ENTRIES = 250_000
RANGES = 16_384
SAMPLE_PER_RANGE = 20
LEVEL = 3

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ENTRY = "struct<key:string,time:string,id:bigint,archive:string,offset:bigint,length:bigint>"


def url_key(url: Column) -> Column:
    """Reversed host labels, a bracket and the rest of the URL, ASCII letters in lower case."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    tail = F.substring(rest, F.length(host) + 1, F.length(rest))
    labels = F.array_join(F.reverse(F.split(host, r"\.", -1)), ",")
    key = F.translate(F.concat(labels, F.lit(")"), tail), UPPER, LOWER)
    return F.when(at > 0, key).otherwise("")


# --- records -----------------------------------------------------------------


def record(page: dict) -> bytes:
    """One gzip member that holds a WARC record."""
    revisit = page["refers_to"] is not None
    payload = b"" if revisit else page["payload"].encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page['id'] is None else page['id']}>",
        f"WARC-Date: {page['time'] or ''}",
        f"WARC-Target-URI: {(page['url'] or '').encode('unicode_escape').decode()}",
        f"WARC-Payload-Digest: sha1:{page['digest']}",
        f"X-Payload-Length: {page['bytes']}",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(payload)}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{page['refers_to']}>"]
    head = "\r\n".join(lines) + "\r\n\r\n"
    return gzip.compress(head.encode() + payload + b"\r\n\r\n", LEVEL, mtime=0)


def page_number(urn: str | None) -> int | None:
    digits = urn.removeprefix("<urn:page:").removesuffix(">") if urn else ""
    return int(digits) if digits else None


def parse(data: bytes) -> dict:
    """What a record says, its payload checked against its digest."""
    head, _, body = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    payload = body[: int(fields["Content-Length"])]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not have its digest")
    return {
        "id": page_number(fields["WARC-Record-ID"]),
        "bytes": int(fields["X-Payload-Length"]),
        "digest": digest,
        "type": fields["WARC-Type"],
        "refers_to": page_number(fields.get("WARC-Refers-To")),
        "payload": payload,
    }


# --- writing -----------------------------------------------------------------


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Archives and index blocks of a sorted partition."""
    task = TaskContext.get().partitionId()
    entry_type = pa.struct(
        [("key", pa.string()), ("time", pa.string()), ("id", pa.int64())]
        + [("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]
    )

    def row(kind: str, name: str, n: int, data: bytes | None, entries: list | None) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {
                "kind": pa.array([kind]),
                "run": pa.array([task], pa.int32()),
                "n": pa.array([n], pa.int32()),
                "name": pa.array([name], pa.string()),
                "data": pa.array([data], pa.binary()),
                "entries": pa.array([entries], pa.list_(entry_type)),
            }
        )

    archives, n_blocks, out, entries = 0, 0, io.BytesIO(), []
    for batch in batches:
        for i in range(batch.num_rows):
            page = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            member, name = record(page), f"{task:06d}-{archives:06d}.warc.gz"
            place = {"archive": name, "offset": out.tell(), "length": len(member)}
            entries.append({"key": page["key"], "time": page["time"], "id": page["id"]} | place)
            out.write(member)
            if len(entries) == BLOCK_ENTRIES:
                yield row("run", "", n_blocks, None, entries)
                entries, n_blocks = [], n_blocks + 1
            if out.tell() >= ARCHIVE_BYTES:
                yield row("archive", name, archives, out.getvalue(), None)
                out, archives = io.BytesIO(), archives + 1
    if out.tell():
        yield row("archive", f"{task:06d}-{archives:06d}.warc.gz", archives, out.getvalue(), None)
    if entries:
        yield row("run", "", n_blocks, None, entries)


def write_archives(
    pages: DataFrame,
    path: str,
    id_column: str = "page_id",
    url: str = "url",
    payload: str = "html",
    time: Column | None = None,
) -> None:
    """Write the archives and index runs of all pages; ids are whole numbers.

    ``time`` is the capture time as ISO text; without one, the ids count seconds.
    """
    if time is None:
        seconds = F.timestamp_seconds(F.coalesce(F.col(id_column), F.lit(0)) + F.lit(1704067200))
        time = F.date_format(seconds, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    body = F.coalesce(F.col(payload), F.lit(""))
    own = pages.select(
        F.col(id_column).cast("bigint").alias("id"),
        F.col(url).alias("url"),
        body.alias("payload"),
        F.sha1(body.cast("binary")).alias("digest"),
        F.octet_length(body).cast("bigint").alias("bytes"),
        time.alias("time"),
        url_key(F.col(url)).alias("key"),
    )
    repeated = (
        own.filter(F.col("bytes") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.max("id").alias("largest"), F.count("*").alias("copies"))
        .filter("copies > 1")
        .select(F.col("digest").alias("of"), "largest")
    )
    is_revisit = F.col("largest").isNotNull() & ~F.col("id").eqNullSafe(F.col("largest"))
    (
        own.join(repeated, (F.col("digest") == F.col("of")) & (F.col("bytes") >= REVISIT_BYTES), "left")
        .withColumn("refers_to", F.when(is_revisit, F.col("largest")))
        .sortWithinPartitions("key", "time", "id")
        .select("key", "time", "id", "url", "digest", "bytes", "refers_to", F.when(~is_revisit, F.col("payload")).alias("payload"))
        .mapInArrow(_write, f"kind string, run int, n int, name string, data binary, entries array<{ENTRY}>")
        .write.partitionBy("kind")
        .option("compression", "none")
        .parquet(path)
    )


# --- merging -----------------------------------------------------------------


def order_of(entry: dict) -> tuple:
    known = entry["id"] is not None
    return (
        (entry["key"] or "").encode(),
        (entry["time"] or "").encode(),
        known,
        entry["id"] if known else 0,
        entry["archive"] or "",
        entry["offset"] or 0,
    )


class LoserTree:
    """Merges sorted sources. Inner nodes keep the loser of their match, node 0 the winner,
    so that an entry's successor plays one match per level."""

    END = (1,)

    def __init__(self, sources: list[Iterator], order):
        self.sources, self.order = sources, order
        self.k = max(1, len(sources))
        self.heads: list = [None] * self.k
        self.ranks: list[tuple] = [self.END] * self.k
        for i in range(len(sources)):
            self._advance(i)
        self.tree = [-1] * self.k
        winners = [*([-1] * self.k), *range(self.k)]
        for node in range(self.k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.tree[node] = (a, b) if self._before(a, b) else (b, a)
        self.tree[0] = winners[1] if self.k > 1 else 0

    def _advance(self, i: int) -> None:
        self.heads[i] = next(self.sources[i], None)
        self.ranks[i] = self.END if self.heads[i] is None else (0, self.order(self.heads[i]))

    def _before(self, a: int, b: int) -> bool:
        return (self.ranks[a], a) < (self.ranks[b], b)

    def __iter__(self) -> Iterator:
        while True:
            winner = self.tree[0]
            head = self.heads[winner]
            if head is None:
                return
            yield head
            self._advance(winner)
            node = (winner + self.k) // 2
            while node:
                if self._before(self.tree[node], winner):
                    winner, self.tree[node] = self.tree[node], winner
                node //= 2
            self.tree[0] = winner


def _cut(bounds: list):
    """Pieces of index blocks by range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field("entries").type
            for i in range(batch.num_rows):
                entries = batch.column("entries")[i].as_py()
                at = [bisect_right(bounds, order_of(e)) for e in entries]
                cuts = [j for j in range(len(at)) if not j or at[j] != at[j - 1]]
                for first, last in zip(cuts, [*cuts[1:], len(at)], strict=True):
                    yield pa.RecordBatch.from_pydict(
                        {
                            "part": pa.array([at[first]], pa.int32()),
                            "run": batch.column("run").slice(i, 1),
                            "n": batch.column("n").slice(i, 1),
                            "entries": pa.array([entries[first:last]], kind),
                        }
                    )

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merged entries of the ranges of a partition, which are sorted by range, run and block."""

    def out(part: int, runs: dict[int, list[list]]) -> Iterator[pa.RecordBatch]:
        sources = [(e for block in blocks for e in block) for blocks in runs.values()]
        merged = [
            (part, place, e["key"], e["time"], e["id"], e["archive"], e["offset"], e["length"])
            for place, e in enumerate(LoserTree(sources, order_of))
        ]
        names = ["part", "place", "key", "time", "id", "archive", "offset", "length"]
        kinds = [pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        columns = zip(*merged, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    current, runs = None, {}
    for batch in batches:
        for row in batch.to_pylist():
            if row["part"] != current:
                if runs:
                    yield from out(current, runs)
                current, runs = row["part"], {}
            runs.setdefault(row["run"], []).append(row["entries"])
    if runs:
        yield from out(current, runs)


def capture_history(spark: SparkSession, path: str) -> DataFrame:
    """The merged index: entries in global order by (part, place)."""
    runs = spark.read.parquet(path).filter("kind = 'run'").select("run", "n", "entries")
    count = runs.agg(F.sum(F.size("entries"))).first()[0] or 0
    ranges = min(RANGES, -(-count // RANGE_ENTRIES))
    bounds = []
    if ranges > 1:
        drawn = (
            runs.select(F.explode("entries").alias("e"))
            .orderBy(F.xxhash64("e"))
            .limit(ranges * SAMPLE_PER_RANGE)
            .collect()
        )
        found = sorted(order_of(r.e.asDict()) for r in drawn)
        bounds = sorted({found[int(i * len(found) / ranges)] for i in range(1, ranges)})
    return (
        runs.mapInArrow(_cut(bounds), f"part int, run int, n int, entries array<{ENTRY}>")
        .repartition(len(bounds) + 1, "part")
        .sortWithinPartitions("part", "run", "n")
        .mapInArrow(
            _merge,
            "part int, place bigint, key string, time string, id bigint, archive string, offset bigint, length bigint",
        )
    )


RECORD = pa.schema(
    [("archive", pa.string()), ("offset", pa.int64()), ("id", pa.int64()), ("bytes", pa.int64())]
    + [("digest", pa.string()), ("type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
)


def members(data: bytes) -> Iterator[tuple[int, bytes]]:
    """Offset and content of the gzip members that follow each other in an archive."""
    at = 0
    while at < len(data):
        unpacker = zlib.decompressobj(31)
        raw = unpacker.decompress(memoryview(data)[at:])
        yield at, raw
        at = len(data) - len(unpacker.unused_data)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives with its place, payloads checked against digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column("name").to_pylist(), batch.column("data"), strict=True):
                rows = [parse(raw) | {"archive": name, "offset": at} for at, raw in members(data.as_py())]
                yield pa.RecordBatch.from_pylist(rows, schema=RECORD)

    archives = spark.read.parquet(path).filter("kind = 'archive'").select("name", "data")
    return archives.mapInArrow(
        run,
        "archive string, offset bigint, id bigint, bytes bigint, digest string, type string, "
        "refers_to bigint, payload binary",
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The capture histories in global order, each entry with the record it points to."""
    path = scratch_path(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    records = read_archives(spark, path).drop("payload", "id")
    history = capture_history(spark, path)
    return history.join(records, ["archive", "offset"]).select(
        F.col("id").alias("page_id"),
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        "refers_to",
        "part",
        "place",
    )


query = op6_warc
ORACLE_SQL = None
