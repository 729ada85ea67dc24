"""Operator 12: bytes of strings that occur twice, by suffix arrays of shards.

A string of ``WINDOW`` bytes that starts in two places holds the same anchor in both: of
its substrings of ``GRAM`` bytes, the one with the smallest hash. So all that can match
meets at the anchors:

1. every text names its anchors, each with a hash of its surroundings (the ``REACH``
   bytes before it and ``WINDOW`` bytes from it, which hold every string with this
   anchor). Anchors that occur once are left out: a first pass over the texts counts
   them, and a bitmap of fixed size keeps the others' rows from being made. These rows
   are stored, so that texts are searched for anchors twice and not again for spans;
2. surroundings that occur twice repeat throughout. Where an anchor has several
   different surroundings, one copy of each is fetched, and shards of at least ``SHARD``
   of them are cut into phrases at content-defined places. The suffix array of a shard's
   phrases (``suffixgroups``) and its common prefixes say which strings agree between
   their first and last phrase bounds; the bytes outside are compared by their hash;
3. an anchor with more than ``CHUNK`` different surroundings is taken band by band: the
   strings of a band start within ``BAND`` bytes of each other, so all of them hold its
   core, and only surroundings with an equal core meet. Where more than ``CHUNK`` do, they
   are dealt to several shards; each names the strings it has found twice and those it has
   once, and they are counted over the shards;
4. the spans go back to their texts, where they are merged.

Pairs of an anchor and its surroundings with more copies than a ten-thousandth of all
are few by that definition: their spans are broadcast. Other keys are as large as one
document. Rows are known by a 64-bit hash of id and text, with the length; surroundings
by two hashes of 64 bits; strings within an anchor by one of 64 bits.

Edge cases: a null text is empty; a text shorter than ``WINDOW`` loses nothing and takes
nothing from others. Repeated rows count as two texts, so all of theirs is removed if they
are long enough. Ids may be null or repeat. Other columns travel in a struct, so their
names cannot clash. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickflow.llm.suffixgroups import common_prefixes, suffix_array
from wickflow.llm.texts import BASE, BYTE_VALUES, Texts, blocks, mixed, powers
from wickflow.session import scratch_path

WINDOW = 200
GRAM = 64
REACH = WINDOW - GRAM  # bytes of a string before its anchor, at most
# Phrase bounds are anchors of the same kind, chosen among PICK starts.
PHRASE_GRAM = 8
PICK = 93
INNER = PICK + PHRASE_GRAM - 1

PIECE = 1 << 20
BLOCK = 1 << 20
SIEVE_BITS = 26
SHARD = 2_000
CHUNK = 4_000
BAND = 18
HEAVY = 10_000

_PLACE_BITS = np.uint64(22)
_PLACES = np.uint64((1 << 22) - 1)
_REACHED = PIECE + 4 * WINDOW


def _inverse_powers(n: int) -> np.ndarray:
    base, inverse = int(BASE), 1
    for _ in range(6):
        inverse = inverse * (2 - base * inverse) % (1 << 64)
    out = np.full(n, inverse, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Hashes:
    """Hashes of any spans of a byte array."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_VALUES[data] * powers(n), out=self.sums[1:])
        self.back = _inverse_powers(n + 1)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.back[start]
        return mixed(raw + (end - start).astype(np.uint64))

    def grams(self, size: int) -> np.ndarray:
        """Of every span of ``size`` bytes."""
        n = max(0, len(self.sums) - size)
        return mixed((self.sums[size:] - self.sums[:n]) * self.back[:n])


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """For each start, the place of the smallest of ``width`` values (the last, if equal)."""
    if len(values) < width:
        return np.empty(0, np.int64)
    low = (values & ~_PLACES) | (_PLACES - np.arange(len(values), dtype=np.uint64))
    size = 1
    while 2 * size <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < width:
        rest = width - size
        low = np.minimum(low[:-rest], low[rest:])
    return (_PLACES - (low & _PLACES)).astype(np.int64)


def anchors(texts: Texts) -> dict[str, np.ndarray]:
    """Text, place in it, hash and hash of the surroundings of every anchor."""
    data, bounds = texts.data, texts.offsets
    found = []
    for first in range(0, max(1, len(data) - WINDOW + 1), PIECE):
        low, high = max(0, first - REACH), min(len(data), first + PIECE + WINDOW + REACH)
        hashes = Hashes(data[low:high])
        grams = hashes.grams(GRAM)
        chosen = smallest(grams, REACH + 1)
        starts = np.arange(len(chosen)) + low
        owner = np.searchsorted(bounds, starts, "right") - 1
        mine = (starts >= first) & (starts < first + PIECE) & (starts + WINDOW <= bounds[owner + 1])
        place = np.unique(chosen[mine])
        own = np.searchsorted(bounds, place + low, "right") - 1
        begin = np.maximum(bounds[own] - low, place - REACH)
        end = np.minimum(bounds[own + 1] - low, place + WINDOW)
        around = mixed(hashes.spans(begin, end) + (place - begin).astype(np.uint64))
        found.append((own, place + low - bounds[own], grams[place], around))
    own, at, anchor, around = (np.concatenate(c) for c in zip(*found, strict=True))
    _, once = np.unique(bounds[own] + at, return_index=True)
    return {
        "text": own[once],
        "at": at[once],
        "anchor": anchor[once].view(np.int64),
        "around": around[once].view(np.int64),
    }


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, texts in blocks(batches, "text", BLOCK):
        hashes, n = np.unique(anchors(texts)["anchor"], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(n, pa.int64())], ["anchor", "n"])


def _occurrences(sieve):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(sieve.value, np.uint8)
        for part, texts in blocks(batches, "text", BLOCK):
            found = anchors(texts)
            bit = found["anchor"] & ((1 << SIEVE_BITS) - 1)
            kept = np.flatnonzero((bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1)
            key = np.asarray(part.column("key"))
            own = found["text"][kept]
            sizes = np.diff(texts.offsets)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key[own]),
                    pa.array(sizes[own], pa.int32()),
                    pa.array(found["at"][kept], pa.int32()),
                    pa.array(found["anchor"][kept]),
                    pa.array(found["around"][kept]),
                ],
                ["key", "size", "at", "anchor", "around"],
            )

    return run


def _fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes around the wanted anchors of each text: whole (band -1), or for each band
    of starts the bytes of its strings and a hash of those they all hold."""
    for part, texts in blocks(batches, "text", BLOCK):
        wanted = part.column("wanted")
        counts = np.diff(np.asarray(wanted.offsets))
        flat = wanted.flatten()
        own = np.repeat(np.arange(len(texts)), counts)
        place = texts.offsets[own] + np.asarray(flat.field("at")).astype(np.int64)
        split = np.asarray(flat.field("split")).astype(np.int64)
        low, high = texts.offsets[own], texts.offsets[own + 1]
        data, hashes = texts.data.tobytes(), Hashes(texts.data)
        for band in range(-1, -(-(REACH + 1) // BAND)):
            least, most = (-REACH, 0) if band < 0 else (-REACH + band * BAND, min(0, -REACH + band * BAND + BAND - 1))
            begin, end = np.maximum(low, place + least), np.minimum(high, place + most + WINDOW)
            mine = np.flatnonzero((split == (band >= 0)) & (end - begin >= WINDOW))
            begin, end, at = begin[mine], end[mine], place[mine]
            core = np.zeros(len(mine), np.uint64) if band < 0 else hashes.spans(at + most, at + least + WINDOW)
            rows = pa.array(mine)
            yield pa.RecordBatch.from_arrays(
                [
                    *(flat.field(name).take(rows) for name in ("anchor", "around", "copies")),
                    pa.array(np.full(len(mine), band, np.int32)),
                    pa.array(core.view(np.int64)),
                    pa.array(at - begin, pa.int32()),
                    pa.array([data[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)], pa.binary()),
                ],
                ["anchor", "around", "copies", "band", "core", "before", "bytes"],
            )


def string_classes(
    data: np.ndarray, bounds: np.ndarray, before: np.ndarray, group: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All strings of ``WINDOW`` bytes with the anchor of their surroundings.

    Surroundings i are ``data[bounds[i]:bounds[i + 1]]``, ``before[i]`` bytes of them before
    the anchor. Gives the surroundings of each string, its start relative to the anchor,
    a code that is equal for equal strings at equal starts in equal groups, and a hash.
    """
    hashes = Hashes(data)
    lengths = np.diff(bounds)
    counts = np.maximum(0, lengths - WINDOW + 1)
    owner = np.repeat(np.arange(len(lengths)), counts)
    start = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts) + bounds[owner]

    bound_after = smallest(hashes.grams(PHRASE_GRAM), PICK)  # of each start, its phrase bound
    begins = np.arange(len(bound_after))
    inside = begins + INNER <= bounds[np.searchsorted(bounds, begins, "right")]
    phrase = np.unique(bound_after[inside])
    phrase_owner = np.searchsorted(bounds, phrase, "right") - 1
    phrase_end = np.minimum(np.concatenate([phrase[1:], [len(data)]]), bounds[phrase_owner + 1])
    _, names = np.unique(hashes.spans(phrase, phrase_end), return_inverse=True)
    # 1 ends the phrases of each surroundings, 0 ends the text
    symbols = np.ones(len(phrase) + len(lengths) + 1, np.int64)
    symbols[-1] = 0
    at = np.arange(len(phrase)) + phrase_owner
    symbols[at] = names + 2

    number = np.zeros(len(data) + 1, np.int64)
    number[phrase] = np.arange(len(phrase))
    head = bound_after[start]
    tail = bound_after[start + WINDOW - INNER]
    depth = number[tail] - number[head]
    array = suffix_array(symbols)
    rank = np.empty(len(array), np.int64)
    rank[array] = np.arange(len(array))
    shared = common_prefixes(symbols, array, int(depth.max(initial=0)))
    place = rank[at[number[head]]]
    same = np.zeros(len(start), np.int64)
    by_depth = np.argsort(depth, kind="stable")
    cuts = np.concatenate([[0], np.cumsum(np.bincount(depth))]) if len(depth) else [0]
    for d in range(1, len(cuts) - 1):
        if cuts[d] < cuts[d + 1]:
            own = by_depth[cuts[d] : cuts[d + 1]]
            since = np.maximum.accumulate(np.where(shared < d, np.arange(len(array)), 0))
            same[own] = since[place[own]]

    relative = start - bounds[owner] - before[owner]
    code = group[owner].astype(np.uint64) * np.uint64(2 * WINDOW) + (relative + REACH).astype(np.uint64)
    for part in (depth.astype(np.uint64), same.astype(np.uint64), hashes.spans(start, head), hashes.spans(tail, start + WINDOW)):
        code = mixed(code + part)
    return owner, relative, code, hashes.spans(start, start + WINDOW)


def _shard(
    anchor: np.ndarray,
    around: np.ndarray,
    copies: np.ndarray,
    group: np.ndarray,
    chunks: np.ndarray,
    before: np.ndarray,
    column: pa.Array,
) -> Iterator[pa.RecordBatch]:
    """Repeated strings of a shard: runs of starts (``win`` null), and of groups in several
    shards the strings met twice (``around`` null) or once."""
    texts = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.empty(0, np.uint8)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data, bounds = texts[ends[0] : ends[-1]], ends - ends[0]
    owner, relative, code, win = string_classes(data, bounds, before, group)
    _, inverse, met = np.unique(code, return_inverse=True, return_counts=True)
    twice = (met[inverse] > 1) | (copies[owner] > 1)
    split = chunks[owner] > 1

    run = np.flatnonzero(twice & (copies[owner] == 1))
    edge = np.ones(len(run), bool)
    edge[1:] = (np.diff(run) > 1) | (np.diff(owner[run]) > 0)
    first = run[edge]
    last = run[np.concatenate([edge[1:], [True]])[: len(run)]]
    pieces = [(anchor[owner[first]], around[owner[first]], None, relative[first], relative[last], None)]
    again = np.flatnonzero(split & twice)
    again = again[np.unique(code[again], return_index=True)[1]]
    pieces.append((anchor[owner[again]], None, np.full(len(again), 2), relative[again], relative[again], win[again]))
    once = np.flatnonzero(split & ~twice)
    pieces.append((anchor[owner[once]], around[owner[once]], np.full(len(once), 1), relative[once], relative[once], win[once]))
    for own, near, n, a, b, w in pieces:
        if len(own):
            null = pa.nulls(len(own), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(own),
                    null if near is None else pa.array(near),
                    null if n is None else pa.array(n, pa.int64()),
                    pa.array(a, pa.int32()),
                    pa.array(b, pa.int32()),
                    null if w is None else pa.array(w.view(np.int64)),
                ],
                ["anchor", "around", "n", "first", "last", "win"],
            )


GROUP = ("anchor", "band", "core", "chunk")


def _sharded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group, cut into shards between groups."""

    def groups(table: pa.Table) -> np.ndarray:
        """The number of each row's group, in order."""
        fresh = np.zeros(table.num_rows, bool)
        for name in GROUP:
            column = np.asarray(table.column(name))
            fresh[1:] |= column[1:] != column[:-1]
        return np.cumsum(fresh)

    def solved(table: pa.Table) -> Iterator[pa.RecordBatch]:
        group = groups(table)
        pair = np.stack([group, np.asarray(table.column("around"))])
        once = np.sort(np.unique(pair, axis=1, return_index=True)[1])  # repeated rows fetch the same
        table = table.take(once).combine_chunks()
        anchor, around, copies, chunks, before = (
            np.asarray(table.column(c)) for c in ("anchor", "around", "copies", "chunks", "before")
        )
        yield from _shard(anchor, around, copies, group[once], chunks, before, table.column("bytes").combine_chunks())

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        while rows > SHARD:
            table = pa.Table.from_batches(held)
            edges = np.flatnonzero(np.diff(groups(table))) + 1
            edges = edges[edges >= SHARD]
            if not len(edges):
                break
            yield from solved(table.slice(0, int(edges[0])))
            rest = table.slice(int(edges[0]))
            held, rows = rest.to_batches(), rest.num_rows
    if rows:
        yield from solved(pa.Table.from_batches(held))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of each text in order, those that touch as one."""
    for batch in batches:
        spans = batch.column("spans")
        flat = spans.flatten()
        start, end = (np.asarray(flat.field(c)).astype(np.int64) for c in ("start", "end"))
        owner = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(spans.offsets)))
        order = np.lexsort((start, owner))
        owner, start, end = owner[order], start[order], end[order]
        base = owner << 32  # texts are shorter
        reach = np.maximum.accumulate(base + end)
        fresh = np.ones(len(start), bool)
        fresh[1:] = base[1:] + start[1:] > reach[:-1]
        heads = np.flatnonzero(fresh)
        stops = reach[np.concatenate([heads[1:] - 1, [len(reach) - 1]])] - base[heads] if len(heads) else heads
        offsets = np.searchsorted(owner[heads], np.arange(batch.num_rows + 1))
        values = pa.StructArray.from_arrays([pa.array(start[heads]), pa.array(stops)], ["start", "end"])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("size"), lists], ["key", "size", "spans"]
        )


def _sieve(spark: SparkSession, hashes: DataFrame):
    """A bitmap of the hashes' lower bits, of ``2 ** SIEVE_BITS`` bits whatever their number."""
    bit = F.col("anchor").bitwiseAND(F.lit((1 << SIEVE_BITS) - 1))
    rows = (
        hashes.select(F.shiftright(bit, 15).alias("page"), (bit % 32768).alias("bit"))
        .groupBy("page")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .collect()  # at most 2 ** (SIEVE_BITS - 15) pages of 4 KB
    )
    whole = bytearray(1 << (SIEVE_BITS - 3))
    for row in rows:
        whole[row.page << 12 : (row.page + 1) << 12] = row.bits
    return spark.sparkContext.broadcast(bytes(whole))


def repeated_spans(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``size`` and the merged ``spans`` of every text that loses any; keys are those
    of ``with_keys``."""
    spark = docs.sparkSession

    def stored(df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(spark, label)
        df.write.parquet(path)
        return spark.read.parquet(path)

    texts = with_keys(docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")), "id", "text")
    texts = texts.select("key", "size", "text").filter(F.col("size") >= WINDOW)
    counted = texts.select("text").mapInArrow(_counted, "anchor bigint, n bigint")
    sieve = _sieve(spark, counted.groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1"))
    # read three times: by pair, and for the spans of heavy and of other pairs
    occurrences = stored(
        texts.select("key", "text").mapInArrow(
            _occurrences(sieve), "key bigint, size int, at int, anchor bigint, around bigint"
        ),
        "occurrences",
    )
    pair = ["anchor", "around"]
    pairs = stored(
        occurrences.groupBy(*pair).agg(
            F.count("*").alias("copies"), F.min(F.struct("key", "size", "at")).alias("where")
        ),
        "surroundings",
    )
    several = pairs.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1")
    wanted = (
        pairs.join(several, "anchor")
        .select("where.*", *pair, F.least("copies", F.lit(2)).alias("copies"), (F.col("n") > CHUNK).alias("split"))
        .groupBy("key", "size")
        .agg(F.collect_list(F.struct("at", *pair, "copies", F.col("split").cast("int").alias("split"))).alias("wanted"))
    )
    fetched = stored(
        texts.join(wanted, ["key", "size"])
        .select("text", "wanted")
        .mapInArrow(_fetched, "anchor bigint, around bigint, copies bigint, band int, core bigint, before int, bytes binary"),
        "fetched",
    )
    banded = fetched.filter("band >= 0")
    cores = banded.groupBy(*GROUP[:3]).agg(F.count("*").alias("n")).filter("n > 1")
    met = banded.join(cores.withColumn("chunks", F.ceil(F.col("n") / CHUNK)).drop("n"), list(GROUP[:3]))
    shards = (
        fetched.filter("band < 0")
        .withColumn("chunks", F.lit(1).cast("long"))
        .unionByName(met)
        .withColumn("chunk", F.pmod("around", "chunks"))
        .repartition(*GROUP)
        .sortWithinPartitions(*GROUP)
    )
    found = stored(
        shards.mapInArrow(_sharded, "anchor bigint, around bigint, n bigint, first int, last int, win bigint"),
        "repeated-strings",
    )
    across = found.filter("win IS NOT NULL")
    string = ["anchor", "first", "win"]
    met = across.groupBy(*string).agg(F.sum("n").alias("met")).filter("met > 1").drop("met")
    runs = (
        found.filter("win IS NULL")
        .select(*pair, "first", "last")
        .unionByName(across.filter("n = 1").join(met, string).select(*pair, "first", "last"))
        .unionByName(
            pairs.filter("copies > 1").select(*pair, F.lit(-REACH).alias("first"), F.lit(0).alias("last"))
        )
    )
    total = pairs.agg(F.sum("copies")).first()[0] or 0
    many = max(HEAVY, total // HEAVY)  # so at most HEAVY pairs are heavy
    heavy = F.broadcast(pairs.filter(F.col("copies") > many).select(*pair))
    whole = occurrences.join(heavy, pair, "left_semi")
    rest = occurrences.join(heavy, pair, "left_anti").join(runs, pair)
    span = F.struct(
        F.greatest(F.col("at") + F.col("first"), F.lit(0)).alias("start"),
        F.least(F.col("at") + F.col("last") + WINDOW, F.col("size")).alias("end"),
    )
    spans = rest.select("key", "size", span.alias("span")).unionByName(
        whole.withColumns({"first": F.lit(-REACH), "last": F.lit(0)}).select("key", "size", span.alias("span"))
    )
    return (
        spans.groupBy("key", "size")
        .agg(F.collect_list("span").alias("spans"))
        .mapInArrow(_merged, "key bigint, size int, spans array<struct<start:bigint,end:bigint>>")
    )


def with_keys(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """The columns and ``key`` and ``size``, which stand for id and text."""
    own = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns(
        {"key": F.xxhash64(F.col(id_column).cast("string"), own), "size": F.octet_length(own)}
    )


def find_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row: the text, the other columns as the struct ``row``, and the ``spans`` of
    bytes to remove, in order and apart."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    packed = docs.select(F.struct(*others).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    keyed = with_keys(packed, f"row.{id_column}", "text")
    none = F.expr("CAST(array() AS array<struct<start:bigint,end:bigint>>)")
    found = keyed.join(repeated_spans(docs, id_column, text), ["key", "size"], "left")
    return found.select("row", "text", F.coalesce("spans", none).alias("spans"))


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in blocks(batches, "text", BLOCK):
        spans = part.column("spans")
        offsets, flat = np.asarray(spans.offsets), spans.flatten()
        start, end = (np.asarray(flat.field(c)) for c in ("start", "end"))
        removed, digests = [], []
        data = texts.data.tobytes()
        for i in range(len(texts)):
            low, high = int(texts.offsets[i]), int(texts.offsets[i + 1])
            own = range(offsets[i] - offsets[0], offsets[i + 1] - offsets[0])
            digest, at = hashlib.sha256(), low
            for k in own:
                digest.update(data[at : low + int(start[k])])
                at = low + int(end[k])
            digest.update(data[at:high])
            removed.append(sum(int(end[k] - start[k]) for k in own))
            digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                pa.array(np.diff(texts.offsets), pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(np.diff(offsets), pa.int64()),
                pa.array(digests, pa.string()),
            ],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return (
        find_repeats(docs)
        .select("row.doc_id", "text", "spans")
        .mapInArrow(_digested, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    )


query = op12_repeats
ORACLE_SQL = None
