"""Operator 3: token ids in bit planes.

Documents are range-partitioned and sorted by id; each partition is a shard. A shard is a
row of chunks of whole documents (``CHUNK_IDS`` ids or more, so that reading back needs
no other chunk). A chunk cuts its ids into blocks of ``BLOCK_IDS``, the last one padded
with zeros, and transposes each block: plane b holds bit b of all its ids. The planes of
a chunk are compressed with zstandard one by one. The file is a Parquet table of chunks,
so that it can lie in any store Spark writes to and a lost task is simply written again:

| column | content |
|---|---|
| shard, chunk, start | the chunk index: place, and ids before it in its shard; ``read_range`` seeks by it |
| n_ids, doc_ids, sizes | ids, documents in order and ids of each |
| planes | one zstandard frame per bit, lowest first |

Ids come from the tokenizers library. A text is cut where its pre-tokenizer always cuts
(white space, ASCII letters against punctuation); the pieces of a block are encoded once
each and remembered by their hash, up to ``CACHED`` of them in a worker, of which those
met last stay. Texts with white
space beyond ASCII, control characters or ``<|`` are encoded whole.

Edge cases: a null or empty text has the end id alone. Rows with one id follow each other
in the order of a hash of their text; null ids come first. An empty table gives an empty
file. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wickflow.llm.texts import Texts, blocks, ragged_take, span_hashes
from wickflow.session import scratch_path

CHUNK_IDS = 1 << 18
BLOCK_IDS = 1 << 13
CACHED = 600_000
TOGETHER = 1_000
END = 2
LEVEL = 3

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'"]] = True
_CONTROL = np.zeros(256, bool)
_CONTROL[[*range(0x00, 0x09), *range(0x0E, 0x20), 0x7F]] = True


# --- encoding ----------------------------------------------------------------


def cuts(texts: Texts) -> np.ndarray:
    """Where pieces begin; every text that is not empty begins one."""
    data = texts.data
    n = len(data)
    begins = np.zeros(n + 1, bool)
    if n > 1:
        white, letter, mark = _WHITE[data], _LETTER[data], _PUNCTUATION[data]
        begins[1:-1] = (white[1:] & ~white[:-1]) | (~white[1:] & white[:-1] & (data[:-1] != 0x20))
        begins[1:-1] |= (letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:])
        # the last white character of a run belongs to what follows it
        last = np.zeros(n, bool)
        last[1:-1] = white[1:-1] & white[:-2] & ~white[2:]
        ends = texts.offsets[1:] - 1
        last[ends[ends >= 0]] = False
        begins[:-1] |= last
    begins[texts.offsets] = True
    return np.flatnonzero(begins[:-1])


def whole_texts(texts: Texts) -> np.ndarray:
    """The numbers of the texts that cannot be cut by ASCII rules."""
    data = np.concatenate([texts.data, np.zeros(3, np.uint8)])
    odd = [np.flatnonzero(_CONTROL[texts.data])]
    at = np.flatnonzero((texts.data == ord("<")) & (data[1:-2] == ord("|")))
    odd.append(at)
    at = np.flatnonzero((texts.data == 0xC2) | ((texts.data >= 0xE1) & (texts.data <= 0xE3)))
    lead, second, third = data[at], data[at + 1], data[at + 2]
    white = (lead == 0xC2) & ((second == 0x85) | (second == 0xA0))
    white |= (lead == 0xE1) & (second == 0x9A)
    white |= (lead == 0xE2) & (second == 0x80) & ((third <= 0x8A) | (third == 0xA8) | (third == 0xA9) | (third == 0xAF))
    white |= (lead == 0xE2) & (second == 0x81) & (third == 0x9F)
    white |= (lead == 0xE3) & (second == 0x80) & (third == 0x80)
    odd.append(at[white])
    return np.unique(np.searchsorted(texts.offsets, np.concatenate(odd), "right") - 1)


class Encoder:
    """Ids of texts, with a memory of pieces seen before."""

    def __init__(self, model: bytes):
        self.tokenizer = Tokenizer.from_buffer(model)
        self.known: dict[int, bytes] = {}
        self.older: dict[int, bytes] = {}
        self.line_break = np.array(self.tokenizer.encode("\n", add_special_tokens=False).ids, "<u4")

    def _encode(self, strings: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces, many to a text. Pieces that are not white themselves hold no line
        break, and the pre-tokenizer cuts a single one off on both sides."""
        out: list[bytes] = [b""] * len(pieces)
        alone = [i for i, piece in enumerate(pieces) if piece.isspace()]
        joined = [i for i, piece in enumerate(pieces) if not piece.isspace()]
        groups = [joined[k : k + TOGETHER] for k in range(0, len(joined), TOGETHER)]
        texts = ["\n".join([pieces[i] for i in group]) for group in groups]
        for group, found in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(found.ids, "<u4")
            breaks = np.flatnonzero(ids == self.line_break)
            if len(self.line_break) != 1 or len(breaks) != len(group) - 1:
                alone += group  # white space beyond ASCII has joined a break
                continue
            data = ids.tobytes()
            starts = [0, *(4 * (breaks + 1)).tolist()]
            for i, a, b in zip(group, starts, [*(4 * breaks).tolist(), len(data)], strict=True):
                out[i] = data[a:b]
        for i, own in zip(alone, self._encode([pieces[i] for i in alone]), strict=True):
            out[i] = own
        return out

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a block of texts, and where each text's ids begin."""
        starts = cuts(texts)
        bounds = np.append(starts, len(texts.data))
        hashes = span_hashes(texts.data, starts, bounds[1:])
        unique, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        keys = unique.tolist()
        if len(self.known) > CACHED // 2:  # what is met again stays
            self.known, self.older = {}, self.known
        rows = list(map(self.known.get, keys))
        missing = [i for i, row in enumerate(rows) if row is None]
        if self.older:
            for i in missing:
                if (row := self.older.pop(keys[i], None)) is not None:
                    rows[i] = self.known[keys[i]] = row
            missing = [i for i in missing if rows[i] is None]
        raw = texts.data.tobytes()
        if missing:
            at = where[missing]
            spans = zip(starts[at].tolist(), bounds[at + 1].tolist(), strict=True)
            pieces = [raw[a:b].decode() for a, b in spans]
            for i, row in zip(missing, self._encode_pieces(pieces), strict=True):
                rows[i] = self.known[keys[i]] = row
        flat = np.frombuffer(b"".join(rows), "<u4")
        own = np.zeros(len(rows) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, rows), np.int64, len(rows)) // 4, out=own[1:])
        ids, at = ragged_take(flat, own, inverse)
        at = at[np.searchsorted(starts, texts.offsets)]
        whole = whole_texts(texts).tolist()
        if not whole:
            return ids, at
        rows = [ids[a:b] for a, b in zip(at, at[1:], strict=False)]
        strings = [raw[texts.offsets[i] : texts.offsets[i + 1]].decode() for i in whole]
        for i, own in zip(whole, self._encode(strings), strict=True):
            rows[i] = np.frombuffer(own, "<u4")
        return np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])


_loaded: dict[int, Encoder] = {}


def encoder_of(model: bytes) -> Encoder:
    key = hash(model)
    if key not in _loaded:
        _loaded[key] = Encoder(model)
    return _loaded[key]


# --- planes ------------------------------------------------------------------


def to_planes(ids: np.ndarray) -> list[bytes]:
    """Compressed bit planes of a chunk of ids."""
    width = max(1, int(ids.max(initial=0)).bit_length())
    padded = np.zeros(-(-len(ids) // BLOCK_IDS) * BLOCK_IDS, "<u4")
    padded[: len(ids)] = ids
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little", count=width)
    rows = np.packbits(bits.reshape(-1, BLOCK_IDS, width).transpose(2, 0, 1), axis=2, bitorder="little")
    packer = zstandard.ZstdCompressor(level=LEVEL)
    return [packer.compress(plane.tobytes()) for plane in rows]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    unpacker = zstandard.ZstdDecompressor()
    out = np.zeros((-(-n // BLOCK_IDS) * BLOCK_IDS, 4), np.uint8)
    for bit, plane in enumerate(planes):
        flags = np.unpackbits(np.frombuffer(unpacker.decompress(plane), np.uint8), bitorder="little")
        out[:, bit >> 3] |= flags << (bit & 7)
    return out.view("<u4").ravel()[:n]


# --- files -------------------------------------------------------------------

CHUNK = "shard int, chunk int, start bigint, n_ids bigint, doc_ids array<{kind}>, sizes array<bigint>, planes array<binary>"


def write_tokens(
    docs: DataFrame, path: str, tokenizer_file: str, id_column: str = "doc_id", text: str = "text", end: int = END
) -> None:
    """Write the ids of all texts, each followed by the id ``end``, in ascending order of id."""
    kind = docs.schema[id_column].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(Path(tokenizer_file).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value)
        shard, chunk, start = TaskContext.get().partitionId(), 0, 0
        # documents not written yet: their ids, sizes and numbers
        ids, sizes = np.empty(0, "<u4"), np.empty(0, np.int64)
        docs_held: list[pa.Array] = []

        def written(stop: int) -> pa.RecordBatch:
            """The first ``stop`` of the documents held, as a chunk."""
            listed = pa.concat_arrays(docs_held)
            n = int(sizes[:stop].sum())
            docs_held[:] = [listed[stop:]]
            return pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([shard], pa.int32()),
                    "chunk": pa.array([chunk], pa.int32()),
                    "start": pa.array([start], pa.int64()),
                    "n_ids": pa.array([n], pa.int64()),
                    "doc_ids": pa.ListArray.from_arrays(pa.array([0, stop], pa.int32()), listed[:stop]),
                    "sizes": pa.array([sizes[:stop]], pa.list_(pa.int64())),
                    "planes": pa.array([to_planes(ids[:n])], pa.list_(pa.binary())),
                }
            )

        for part, texts in blocks(batches, "text"):
            found, at = encoder.encode(texts)
            docs_held.append(part.column("id"))
            ids = np.concatenate([ids, np.insert(found, at[1:], end).astype("<u4")])
            sizes = np.concatenate([sizes, np.diff(at) + 1])
            while len(ids) >= CHUNK_IDS:
                stop = int(np.searchsorted(np.cumsum(sizes), CHUNK_IDS, "left")) + 1
                yield written(stop)
                n = int(sizes[:stop].sum())
                ids, sizes, chunk, start = ids[n:], sizes[stop:], chunk + 1, start + n
        if len(sizes):
            yield written(len(sizes))

    ordered = (
        docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("id", "tie")
        .sortWithinPartitions("id", "tie")
        .select("id", "text")
    )
    ordered.mapInArrow(run, CHUNK.format(kind=kind)).write.option("compression", "none").parquet(path)


def _shard_starts(chunks: DataFrame) -> dict[int, int]:
    """Ids before each shard. One row per shard, its number and size, passes through the driver."""
    totals = sorted(chunks.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect())
    before = np.concatenate([[0], np.cumsum([r.n for r in totals])]).tolist()
    return {r.shard: n for r, n in zip(totals, before, strict=False)}


def _documents(chunks: DataFrame, first: dict[int, int], id_column: str) -> DataFrame:
    kind = chunks.schema["doc_ids"].dataType.elementType.simpleString()
    shared = chunks.sparkSession.sparkContext.broadcast(first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                listed = row.column("doc_ids").flatten()
                sizes = np.asarray(row.column("sizes").flatten(), dtype=np.int64)
                ids = from_planes(row.column("planes")[0].as_py(), row.column("n_ids")[0].as_py())
                ends = np.cumsum(sizes)
                start = shared.value[row.column("shard")[0].as_py()] + row.column("start")[0].as_py()
                data = pa.py_buffer(np.ascontiguousarray(ids))
                offsets = pa.py_buffer((4 * np.concatenate([[0], ends])).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        listed,
                        pa.array(start + ends - sizes, pa.int64()),
                        pa.Array.from_buffers(pa.binary(), len(sizes), [None, offsets, data]),
                    ],
                    ["id", "start", "ids"],
                )

    found = chunks.mapInArrow(run, f"id {kind}, start bigint, ids binary")
    return found.withColumnRenamed("id", id_column)


def read_tokens(spark: SparkSession, path: str, id_column: str = "doc_id") -> DataFrame:
    """id, ``start`` (ids of all documents before) and ``ids`` (little-endian unsigned
    32-bit integers) of every document."""
    chunks = spark.read.parquet(path)
    return _documents(chunks, _shard_starts(chunks), id_column)


def chunks_of_range(spark: SparkSession, path: str, first: int, stop: int) -> tuple[DataFrame, dict[int, int]]:
    """The chunks that hold ids ``first`` to ``stop - 1`` of the file, and the shards' starts.

    The index alone says which: no planes are read for it, and the filter on shard and
    start reaches the scan.
    """
    chunks = spark.read.parquet(path)
    starts = _shard_starts(chunks)
    low = max((s for s, n in starts.items() if n <= first), default=0)
    high = max((s for s, n in starts.items() if n < stop), default=-1)
    before = F.col("shard") < low
    before |= (F.col("shard") == low) & (F.col("start") + F.col("n_ids") <= first - starts.get(low, 0))
    after = (F.col("shard") > high) | ((F.col("shard") == high) & (F.col("start") >= stop - starts.get(high, 0)))
    return chunks.filter(~before & ~after & F.lit(first < stop)), starts


def read_range(spark: SparkSession, path: str, first: int, stop: int, id_column: str = "doc_id") -> DataFrame:
    """Documents with ids at places ``first`` to ``stop - 1``, like ``read_tokens``, with the
    ids of the range only. Chunks outside are not opened."""
    found = _documents(*chunks_of_range(spark, path, first, stop), id_column)
    begin = F.greatest("start", F.lit(first))
    end = F.least(F.col("start") + (F.octet_length("ids") / 4).cast("long"), F.lit(stop))
    return found.filter(begin < end).select(
        id_column,
        begin.alias("start"),
        F.substring("ids", ((begin - F.col("start")) * 4 + 1).cast("int"), ((end - begin) * 4).cast("int")).alias("ids"),
    )


def op3_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_tokens(spark, path).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


query = op3_token_planes
ORACLE_SQL = None
