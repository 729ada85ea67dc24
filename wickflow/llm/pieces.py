"""Operator 9: SentencePiece encoding and decoding for merge-type vocabularies.

A text is split into symbols, and an agenda of adjacent pairs, ordered by the score of
their union and then from left to right, is worked off until no pair is in the
vocabulary. If no piece has a space mark after another character, as is usual, no merge
crosses the beginning of a run of spaces; the text then falls into segments with agendas
of their own. A block of texts keeps each distinct segment once, and all of its segments
advance together: every round takes the first entry of each agenda. Segments of more
than ``LONG`` symbols use one heap each, so a text without spaces stays n log n.

Every distinct segment of a block is also encoded by the sentencepiece library, in one
call per Arrow block; a difference raises an error. Symbols outside the vocabulary become
byte pieces, or the unknown id without them.

The model travels as bytes in a broadcast (a vocabulary file, some hundred kB). Memory
is bounded by the block.

Edge cases: a null or empty text has no ids and decodes to the empty string. A space
mark in a text is a space, as in the library. Repeated rows are encoded one by one.
Other columns travel in a struct, so their names cannot clash.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickflow.llm.columns import apart
from wickflow.llm.texts import Texts, blocks, ragged_take, span_hashes

BLOCK_BYTES = 1 << 20
LONG = 48
MARK = "▁"
NONE = np.int64(1) << 62


class Vocabulary:
    """Pieces of a model and the table of pairs that merge."""

    def __init__(self, model: bytes):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = sp.vocab_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(size)]
        pieces = {sp.id_to_piece(i): i for i in range(size) if not special[i]}
        self.size = size
        self.unknown = sp.unk_id()
        self.bytes = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(size) if sp.is_byte(i)}
        self.segments = not any(MARK in p.lstrip(MARK) for p in pieces)
        # symbols: piece ids, and beyond them code points that are no pieces
        self.width = size + 0x110000
        self.symbol = size + np.arange(0x110000, dtype=np.int64)
        for piece, i in pieces.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i
        self.symbol[0x20] = self.symbol[ord(MARK)]
        order = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in pieces.values()}, reverse=True))}
        pairs = {}

        def known(part: str) -> int | None:
            return int(self.symbol[ord(part)]) if len(part) == 1 else pieces.get(part)

        for piece, i in pieces.items():
            for at in range(1, len(piece)):
                left, right = known(piece[:at]), known(piece[at:])
                if left is not None and right is not None:
                    pairs[left * self.width + right] = (order[sp.get_score(i)], i)
        self._table(pairs)
        self.pairs = pairs
        raw = [b"" if special[i] else sp.id_to_piece(i).replace(MARK, " ").encode() for i in range(size)]
        for value, i in self.bytes.items():
            raw[i] = bytes([value])
        raw[self.unknown] = " ⁇ ".encode()
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])])

    def _table(self, pairs: dict[int, tuple[int, int]]) -> None:
        """An open hash table of the pairs, in arrays."""
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, NONE >> 32, np.int32)
        self.unions = np.zeros(1 << bits, np.int32)
        keys = np.fromiter(pairs, np.int64, len(pairs))
        slots = self._slot(keys).tolist()
        self.probes = 1
        for key, slot in zip(keys.tolist(), slots, strict=True):
            n = 1
            while self.keys[slot] >= 0:
                slot, n = (slot + 1) & ((1 << bits) - 1), n + 1
            self.keys[slot] = key
            self.ranks[slot], self.unions[slot] = pairs[key]
            self.probes = max(self.probes, n)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and union of each pair; the rank ``NONE >> 32`` without one."""
        keys = left * self.width + right
        slots = self._slot(keys)
        open_ = np.flatnonzero((self.keys[slots] != keys) & (self.keys[slots] >= 0))
        for _ in range(self.probes):
            if not len(open_):
                break
            slots[open_] = (slots[open_] + 1) & (len(self.keys) - 1)
            at = self.keys[slots[open_]]
            open_ = open_[(at != keys[open_]) & (at >= 0)]
        hit = self.keys[slots] == keys
        return np.where(hit, self.ranks[slots], NONE >> 32), self.unions[slots]

    def agenda(self, symbols: list[int]) -> list[int]:
        """Merged symbols of one segment, by a heap."""
        n = len(symbols)
        symbols = list(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def push(i: int) -> None:
            j = after[i]
            if i >= 0 and j < n and (found := self.pairs.get(symbols[i] * self.width + symbols[j])):
                heap.append((found[0], i, symbols[i], symbols[j], found[1])) if not ready else heapq.heappush(
                    heap, (found[0], i, symbols[i], symbols[j], found[1])
                )

        ready = False
        for i in range(n):
            push(i)
        heapq.heapify(heap)
        ready = True
        while heap:
            _, i, left, right, union = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue
            symbols[i], symbols[j] = union, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return [s for s in symbols if s >= 0]

    def rounds(self, symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged symbols of many short segments, one merge per segment and round."""
        lengths = np.diff(bounds)
        place = bounds[:-1].copy()
        out, left = symbols.copy(), lengths.copy()
        owner = np.repeat(np.arange(len(lengths)), lengths)
        ranks = np.full(len(symbols), NONE >> 32, np.int64)
        unions = np.zeros(len(symbols), np.int64)
        if len(symbols) > 1:
            same = np.flatnonzero(owner[:-1] == owner[1:])
            ranks[same], unions[same] = self.find(symbols[same], symbols[same + 1])
        symbols = symbols.copy()
        while len(symbols):
            heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            first = np.minimum.reduceat(ranks << 32 | np.arange(len(symbols)), heads)
            done = first >= NONE
            if done.any():
                sizes = np.diff(np.append(heads, len(symbols)))
                ended = np.repeat(done, sizes)
                own = owner[heads[done]]
                left[own] = sizes[done]
                target = np.repeat(place[own], sizes[done]) + np.arange(int(sizes[done].sum()))
                target -= np.repeat(np.cumsum(sizes[done]) - sizes[done], sizes[done])
                out[target] = symbols[ended]
            at = first[~done] & 0xFFFFFFFF
            symbols[at] = unions[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            if done.any():
                keep &= ~ended
            moved = np.cumsum(keep) - 1
            symbols, owner, ranks, unions = symbols[keep], owner[keep], ranks[keep], unions[keep]
            at = moved[at]
            changed = np.concatenate([at, at[at > 0] - 1])
            ranks[changed] = NONE >> 32
            changed = changed[changed + 1 < len(symbols)]
            changed = changed[owner[changed] == owner[changed + 1]]
            ranks[changed], unions[changed] = self.find(symbols[changed], symbols[changed + 1])
        ends = np.concatenate([[0], np.cumsum(left)])
        keep = np.arange(ends[-1]) + np.repeat(place - ends[:-1], left)
        return out[keep], ends

    def to_ids(self, symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids for symbols: code points without a piece become bytes or the unknown id."""
        odd = np.flatnonzero(symbols >= self.size)
        if not len(odd):
            return symbols, bounds
        if self.bytes:
            ids = [[self.bytes[b] for b in chr(int(s) - self.size).encode()] for s in symbols[odd]]
        else:
            ids = [[self.unknown]] * len(odd)
        sizes = np.ones(len(symbols), np.int64)
        sizes[odd] = [len(i) for i in ids]
        grown = np.repeat(symbols, sizes)
        starts = np.cumsum(sizes) - sizes
        for at, own in zip(starts[odd].tolist(), ids, strict=True):
            grown[at : at + len(own)] = own
        return grown, np.concatenate([[0], np.cumsum(sizes)])[bounds]

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of segments of UTF-8 bytes (non-empty, the space mark written as a space)."""
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        ends = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[bounds]
        symbols = self.symbol[points]
        sizes = np.diff(ends)
        short = np.flatnonzero(sizes <= LONG)
        if len(short) == len(sizes):
            return self.to_ids(*self.rounds(symbols, ends))
        flat, own = self.rounds(*ragged_take(symbols, ends, short))
        rows: list[np.ndarray] = [flat[0:0]] * len(sizes)
        for i, at in enumerate(short.tolist()):
            rows[at] = flat[own[i] : own[i + 1]]
        for at in np.flatnonzero(sizes > LONG).tolist():
            rows[at] = np.array(self.agenda(symbols[ends[at] : ends[at + 1]].tolist()), np.int64)
        return self.to_ids(np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])]))

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the ids, the leading space of each row still there."""
        data, at = ragged_take(self.raw, self.raw_bounds, ids)
        return data, at[bounds]


def spaced(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The bytes with a space before each text that is not empty, and no space marks."""
    data, offsets = texts.data, texts.offsets
    raw = data.tobytes()
    mark = MARK.encode()
    if mark in raw:
        rows = [raw[a:b].replace(mark, b" ") for a, b in zip(offsets, offsets[1:], strict=False)]
        data = np.frombuffer(b"".join(rows), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    full = np.diff(offsets) > 0
    return np.insert(data, offsets[:-1][full], 0x20), offsets + np.concatenate([[0], np.cumsum(full)])


def segments(data: np.ndarray, offsets: np.ndarray, split: bool) -> np.ndarray:
    """Where segments begin: at the first of a run of spaces, or only at texts."""
    begins = np.zeros(len(data) + 1, bool)
    if split and len(data):
        space = data == 0x20
        begins[:-1] = space
        begins[1:-1] &= ~space[:-1]
    begins[offsets] = True
    return np.flatnonzero(begins[:-1])


def checked(vocabulary: Vocabulary, data: np.ndarray, bounds: np.ndarray, ids: np.ndarray, at: np.ndarray) -> None:
    """Compare with the library, which adds the leading space itself."""
    raw = data.tobytes()
    rows = [i for i in range(len(bounds) - 1) if bounds[i + 1] - bounds[i] > 1]
    expected = vocabulary.library.encode([raw[bounds[i] + 1 : bounds[i + 1]].decode() for i in rows], num_threads=1)
    own = ids.tolist()
    for i, want in zip(rows, expected, strict=True):
        if own[at[i] : at[i + 1]] != want:
            raise ValueError(f"{raw[bounds[i] : bounds[i + 1]]!r}: {own[at[i] : at[i + 1]]}, the library has {want}")


def encode_block(vocabulary: Vocabulary, texts: Texts, check: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids and decoded bytes of a block of texts, each with bounds per text."""
    data, offsets = spaced(texts)
    starts = segments(data, offsets, vocabulary.segments)
    ends = np.append(starts[1:], len(data))
    first = np.searchsorted(starts, offsets)
    hashes = span_hashes(data, starts, ends)
    _, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    all_bounds = np.append(starts, len(data))
    own, bounds = ragged_take(data, all_bounds, where)
    ids, at = vocabulary.encode(own, bounds)
    if check:
        checked(vocabulary, own, bounds, ids, at)
    raw, raw_at = vocabulary.decode(ids, at)
    flat, flat_at = ragged_take(ids, at, inverse)
    text, text_at = ragged_take(raw, raw_at, inverse)
    # a decoded text begins after the space that encoding put before it
    bounds = text_at[first]
    keep = np.ones(len(text), bool)
    filled = np.diff(bounds) > 0
    keep[bounds[:-1][filled]] = False
    return flat, flat_at[first], text[keep], bounds - np.concatenate([[0], np.cumsum(filled)])


_loaded: dict[int, Vocabulary] = {}


def vocabulary_of(model: bytes) -> Vocabulary:
    """The vocabulary, built once per worker process."""
    key = hash(model)
    if key not in _loaded:
        _loaded[key] = Vocabulary(model)
    return _loaded[key]


def encode_documents(
    docs: DataFrame, model_file: str, text: str = "text", check: bool = True, keep: list[str] | None = None
) -> DataFrame:
    """Every row as the struct ``row`` of the columns to ``keep`` (default: all), with its ``ids`` and the
    ``decoded`` text."""
    shared = docs.sparkSession.sparkContext.broadcast(Path(model_file).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(shared.value)
        for part, texts in blocks(batches, "text", BLOCK_BYTES):
            ids, at, raw, raw_at = encode_block(vocabulary, texts, check)
            listed = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))
            decoded = pa.StringArray.from_buffers(
                len(texts), pa.py_buffer(raw_at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(raw))
            )
            own = [part.column(c) for c in back]
            yield pa.RecordBatch.from_arrays([*own, listed, decoded], [*back, "ids", "decoded"])

    packed, row = apart(docs, text, keep)
    back = [c for c in ("rest", "text") if c == "rest" or keep is None or text in keep]
    kinds = [f"{c} {packed.schema[c].dataType.simpleString()}" for c in back]
    encoded = packed.mapInArrow(run, ", ".join([*kinds, "ids array<int>", "decoded string"]))
    return encoded.select(row.alias("row"), "ids", "decoded")


def digests(docs: DataFrame, model_file: str) -> DataFrame:
    encoded = encode_documents(docs, model_file, keep=["doc_id"])
    return encoded.select(
        "row.doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


query = op9_sentencepiece
ORACLE_SQL = None
