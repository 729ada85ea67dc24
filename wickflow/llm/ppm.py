"""Operator 1: language-model scores by prediction by partial matching on bytes.

A text is coded as its lower-cased words, each followed by a space, and then one more
space as its end. A byte is predicted from the ``ORDER`` bytes before it, whatever words
they belong to; before a text stand ``ORDER`` spaces. The trie of contexts is a table: a
node is a context with a symbol and its count in the training texts. From a context in
which n of T occurrences were the symbol and q symbols were seen, the symbol has
probability (n - 1/2) / T and an escape to the next shorter context q / 2T (method D).
After an escape the symbols of the longer context are excluded: their counts in the
shorter one are summed per context and taken off T, their number off q. Behind the
empty context all remaining byte values are equally likely.

A byte and its context are one long, a gram, with the nearest byte of the context on top.
The work is:

1. blocks of documents become coded texts, written once, and the distinct grams and words
   of the block with training counts, dealt to buckets by hash: a gram by the ``NEAR``
   bytes before it, a word by itself. A block sends a bucket one compressed row;
2. a bucket of words sums its counts; a bucket of grams sums its own and builds its part
   of the trie. Contexts of ``NEAR`` bytes and more are whole within a bucket; the shorter
   ones are counted over all blocks and sent to every task, 256 ** ``NEAR`` nodes at most,
   whatever the size of the corpus. The bucket returns to each block the code lengths of
   its grams, in the order they came;
3. a block finds its grams in its coded texts again and sums code lengths per document.

No key is hot: a block asks a bucket once, and a bucket gets a row from a block at most.
There are as many buckets as the square root of the corpus asks for, so that the rows
exchanged are few and the buckets grow slowly.

Edge cases: a null or empty text has the end as its only token. A null id counts as the
empty text for the choice of the held-out rows. Repeated rows are scored, and learned
from, one by one. Without training rows every byte has probability 1/256. Words are the
same if their 64-bit hashes are. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickflow.llm.texts import LOWER, SPACE, Texts, blocks, mixed, span_hashes
from wickflow.session import scratch_path

ORDER = 6
NEAR = 3
BLOCK_BYTES = 12 << 20
# Level of zstandard for coded texts, which are stored and then sent to the answers.
TEXT_LEVEL = 9
# Symbols whose code lengths are looked up at a time.
PIECE = 2 << 20
STRIDE = 1 << 20
# Text of the corpus for one bucket, were buckets to grow with its square.
BUCKET_SCALE = 25_000
SYMBOLS = 256
GRAMS, WORDS = 0, 1
ANSWERS = "block bigint, kind int, bucket int, found binary"


# --- coded texts -------------------------------------------------------------


def coded(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The coded texts end to end, ``ORDER`` spaces before each, and their bounds."""
    n = len(texts)
    gap = b" " * (ORDER + 2)
    raw, at = texts.data.tobytes(), texts.offsets
    data = np.frombuffer(b"".join([gap, gap.join(raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)), gap]), np.uint8)
    inside = ~SPACE[data]
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    # Of a gap, the first byte follows a word or goes; the others are the end of a text
    # and what stands before the next.
    gaps = at + np.arange(n + 1) * len(gap)
    keep[(gaps[:, None] + np.arange(1, len(gap))).ravel()] = True
    keep[:2] = False
    keep[len(data) - ORDER :] = False
    # Text i begins behind the second byte of its gap, where the text before it ends.
    sizes = np.add.reduceat(keep, gaps[:-1] + 2, dtype=np.int64) if n else np.empty(0, np.int64)
    return np.where(inside, LOWER[data], np.uint8(0x20))[keep], np.concatenate([[0], np.cumsum(sizes)])


def grams(stream: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The gram of every symbol of the texts between the bounds, and where each text's begin."""
    symbol = np.ones(len(stream), bool)
    symbol[(bounds[:-1, None] + np.arange(ORDER)).ravel()] = False
    out, have = np.empty(len(stream) - ORDER * (len(bounds) - 1), np.int64), 0
    for a in range(ORDER, len(stream), STRIDE):  # temporary arrays stay small
        b = min(a + STRIDE, len(stream))
        code = stream[a:b].astype(np.int64)
        for back in range(1, ORDER + 1):
            code |= stream[a - back : b - back].astype(np.int64) << (8 * (ORDER + 1 - back))
        code = code[symbol[a:b]]
        out[have : have + len(code)] = code
        have += len(code)
    return out, bounds - ORDER * np.arange(len(bounds))


def node_mask(order: int) -> int:
    """The bits of a gram that its node of the order has."""
    context = (1 << 8 * order) - 1
    return context << 8 * (ORDER + 1 - order) | 0xFF


def word_keys(stream: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, and where each text's begin."""
    inside = np.concatenate([[False], stream != 0x20, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    return span_hashes(stream, starts, ends).view(np.int64), np.searchsorted(starts, bounds)


def in_buckets(keys: np.ndarray, kind: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys in the order of their buckets, and where each bucket begins."""
    by = keys >> 8 * (ORDER + 1 - NEAR) if kind == GRAMS else keys
    bucket = (mixed(by.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _packed(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes, behind their count."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    raw = pa.decompress(data[8:], n * width, "zstd", asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, n).T).view(kind).ravel()


def _text_packed(stream: np.ndarray) -> bytes:
    return pa.Codec("zstd", compression_level=TEXT_LEVEL).compress(pa.py_buffer(stream), asbytes=True)


def _counted(keys: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and how many of each are marked."""
    order = np.argsort(keys)
    keys, train = keys[order], train[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
    return keys[first], np.add.reduceat(train, first, dtype=np.int64) if len(first) else np.empty(0, np.int64)


def _counted_grams(codes: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``_counted``; a gram has bits to spare for the mark, so that no order is needed."""
    codes <<= 1
    codes |= train
    codes.sort()
    new = np.ones(len(codes), bool)
    for a in range(1, len(codes), STRIDE):
        b = min(a + STRIDE, len(codes))
        new[a:b] = (codes[a:b] ^ codes[a - 1 : b - 1]) > 1
    first = np.flatnonzero(new)
    keys = codes[first] >> 1
    codes &= 1
    return keys, np.add.reduceat(codes, first)


def _block_rows(buckets: int):
    columns = ["block", "kind", "bucket", "keys", "ns", "stream", "size", "bounds", "ids", "held", "low", "low_ns", "n_train"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, (part, texts) in enumerate(blocks(batches, "text", BLOCK_BYTES)):
            block = task << 24 | number
            stream, bounds = coded(texts)
            train = ~np.asarray(part.column("held").to_pylist(), dtype=bool)
            words, first = word_keys(stream, bounds)
            found = {WORDS: _counted(words, np.repeat(train, np.diff(first)))}
            del words
            codes, first = grams(stream, bounds)
            found[GRAMS] = _counted_grams(codes, np.repeat(train, np.diff(first)))
            del codes
            own = []
            for kind, (keys, ns) in found.items():
                order, at = in_buckets(keys, kind, buckets)
                keys, ns = keys[order], ns[order].astype(np.int32)
                for bucket in np.flatnonzero(np.diff(at)).tolist():
                    a, b = at[bucket], at[bucket + 1]
                    own.append((kind, bucket, _packed(np.diff(keys[a:b], prepend=np.int64(0))), _packed(ns[a:b])))
            keys, ns = found[GRAMS]
            low, which = np.unique(keys[ns > 0] & node_mask(NEAR - 1), return_inverse=True)
            low_ns = np.bincount(which, ns[ns > 0], minlength=len(low)).astype(np.int64)
            n = len(own)
            rows = pa.RecordBatch.from_arrays(
                [
                    pa.array([block] * n, pa.int64()),
                    pa.array([x[0] for x in own], pa.int32()),
                    pa.array([x[1] for x in own], pa.int32()),
                    pa.array([x[2] for x in own], pa.binary()),
                    pa.array([x[3] for x in own], pa.binary()),
                    *(pa.nulls(n, t) for t in (pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.list_(part.column("id").type))),
                    *(pa.nulls(n, t) for t in (pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64())),
                ],
                columns,
            )
            yield rows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block], pa.int64()),
                    *(pa.nulls(1, t) for t in (pa.int32(), pa.int32(), pa.binary(), pa.binary())),
                    pa.array([_text_packed(stream)], pa.binary()),
                    pa.array([len(stream)], pa.int64()),
                    _one(pa.array(bounds, pa.int64())),
                    _one(part.column("id")),
                    _one(part.column("held")),
                    _one(pa.array(low, pa.int64())),
                    _one(pa.array(low_ns, pa.int64())),
                    pa.array([int(train.sum())], pa.int64()),
                ],
                columns,
            )

    return run


def _one(values: pa.Array) -> pa.ListArray:
    """The whole array as one row."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


# --- buckets -----------------------------------------------------------------


def _asked(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys of a bucket's rows with their counts, the place of each key asked
    for among them, and where the keys of each row begin."""
    keys = [np.cumsum(_unpacked(x, np.int64)) for x in table.column("keys").to_pylist()]
    ns = np.concatenate([_unpacked(x, np.int32) for x in table.column("ns").to_pylist()])
    at = np.concatenate([[0], np.cumsum([len(x) for x in keys])])
    unique, place = np.unique(np.concatenate(keys), return_inverse=True)
    return unique, np.bincount(place, ns, minlength=len(unique)).astype(np.int64), place, at


def _listed(values: np.ndarray) -> bytes:
    """Numbers of which few are distinct: those in order, as steps between their bits, and
    for each number which it is."""
    distinct, which = np.unique(values, return_inverse=True)
    head = _packed(np.diff(distinct.view(np.int64), prepend=np.int64(0)))
    return len(head).to_bytes(8, "little") + head + _packed(which.astype(np.uint32))


def _unlisted(data: bytes, kind: type) -> np.ndarray:
    size = 8 + int.from_bytes(data[:8], "little")
    return np.cumsum(_unpacked(data[8:size], np.int64)).view(kind)[_unpacked(data[size:], np.uint32)]


def _answers(table: pa.Table, values: np.ndarray, place: np.ndarray, at: np.ndarray) -> pa.Table:
    found = [_listed(values[place[a:b]]) for a, b in zip(at[:-1], at[1:], strict=True)]
    return table.select(["block", "kind", "bucket"]).append_column("found", pa.array(found, pa.binary()))


def _word_counts(table: pa.Table) -> pa.Table:
    """Training counts of a bucket's words; the first row has their number and sum too."""
    _, c, place, at = _asked(table)
    out = _answers(table, c, place, at)
    for name, x in (("n", int(c.sum())), ("v", int(np.count_nonzero(c)))):
        out = out.append_column(name, pa.array([x] + [0] * (len(out) - 1), pa.int64()))
    return out


class Level:
    """The nodes of one order with their contexts, and what an escape from a context meets
    in the next shorter one once its own symbols are excluded."""

    def __init__(self, codes: np.ndarray, n: np.ndarray, order: int, shorter: Level | None):
        self.nodes, place = np.unique(codes & node_mask(order), return_inverse=True)
        self.n = np.bincount(place, n, minlength=len(self.nodes)).astype(np.int64)
        owner = self.nodes >> 8
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])[: len(owner)])
        self.contexts = owner[first]
        self.kinds = np.diff(np.append(first, len(owner)))
        self.total = np.add.reduceat(self.n, first) if len(first) else self.n
        if shorter is not None and len(first):
            parents = self.nodes & node_mask(order - 1)
            excluded = np.add.reduceat(shorter.n[np.searchsorted(shorter.nodes, parents)], first)
            above = np.searchsorted(shorter.contexts, parents[first] >> 8)
            self.next_total = shorter.total[above] - excluded
            self.next_kinds = shorter.kinds[above] - self.kinds
        else:
            self.next_total = self.next_kinds = np.zeros(len(first), np.int64)


def _found(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the keys in a sorted table, and whether they are there."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def code_lengths(codes: np.ndarray, levels: list[Level]) -> np.ndarray:
    """The log10 probability of the symbol in its context, for every gram."""
    out = np.zeros(len(codes))
    left = np.arange(len(codes))
    t, q = np.full(len(codes), -1, np.int64), np.zeros(len(codes), np.int64)
    for order in range(len(levels) - 1, -1, -1):
        level = levels[order]
        node = codes[left] & node_mask(order)
        context, known = _found(level.contexts, node >> 8)
        here, context, node = left[known], context[known], node[known]
        fresh = here[t[here] < 0]
        t[fresh], q[fresh] = level.total[context[t[here] < 0]], level.kinds[context[t[here] < 0]]
        at, hit = _found(level.nodes, node)
        done = here[hit]
        out[done] += np.log10((level.n[at[hit]] - 0.5) / t[done])
        missed, context = here[~hit], context[~hit]
        some = t[missed] > 0
        out[missed[some]] += np.log10(q[missed[some]] / (2.0 * t[missed[some]]))
        t[missed], q[missed] = level.next_total[context], level.next_kinds[context]
        left = np.concatenate([left[~known], missed])
    out[left] -= np.log10(SYMBOLS - (levels[0].kinds[0] if len(levels[0].kinds) else 0))
    return out


def _gram_lengths(low):
    def run(table: pa.Table) -> pa.Table:
        codes, n, place, at = _asked(table)
        low_codes, low_n = low.value
        levels: list[Level] = []
        for order in range(ORDER + 1):
            own = (low_codes, low_n) if order < NEAR else (codes[n > 0], n[n > 0])
            levels.append(Level(*own, order, levels[-1] if levels else None))
        return _answers(table, code_lengths(codes, levels), place, at)

    return run


# --- answers -----------------------------------------------------------------


def _sum_documents(n: int, v: int, docs: int, buckets: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.slice(0, 1).combine_chunks()
        raw = pa.decompress(row.column("stream")[0].as_py(), row.column("size")[0].as_py(), "zstd", asbytes=True)
        stream = np.frombuffer(raw, np.uint8)
        bounds = row.column("bounds").combine_chunks().flatten().to_numpy()
        ids, held = (row.column(x).combine_chunks().flatten() for x in ("ids", "held"))
        answers = {(k, b): i for i, (k, b) in enumerate(zip(right.column("kind").to_pylist(), right.column("bucket").to_pylist(), strict=True))}

        def answered(keys: np.ndarray, kind: int, dtype: type) -> np.ndarray:
            order, at = in_buckets(keys, kind, buckets)
            out = np.empty(len(keys), dtype)
            for bucket in np.flatnonzero(np.diff(at)).tolist():
                a, b = at[bucket], at[bucket + 1]
                found = right.column("found")[answers[kind, bucket]].as_py()
                out[order[a:b]] = _unlisted(found, dtype)
            return out

        def per_document(values: np.ndarray, first: np.ndarray) -> np.ndarray:
            return np.bincount(np.repeat(np.arange(len(ids)), np.diff(first)), values, minlength=len(ids))

        words, first_word = word_keys(stream, bounds)
        unique, place = np.unique(words, return_inverse=True)
        c = answered(unique, WORDS, np.int64)[place]
        base = per_document(np.log10((c + 1) / (n + v + 1)), first_word)
        known = per_document(c > 0, first_word)
        codes, first = grams(stream, bounds)
        codes.sort()
        keys = codes[np.concatenate([[True], codes[1:] != codes[:-1]])]
        del codes
        logp = answered(keys, GRAMS, np.float64)
        score = np.zeros(len(ids))
        a = 0
        while a < len(ids):  # pieces of texts, or a single text
            b = max(a + 1, int(np.searchsorted(first, first[a] + PIECE, "right")) - 1)
            codes, _ = grams(stream[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
            own, place = np.unique(codes, return_inverse=True)
            values = logp[np.searchsorted(keys, own)][place]
            score[a:b] = np.add.reduceat(values, first[a:b] - first[a])
            a = b
        return pa.table(
            {
                "id": ids,
                "held_out": held,
                "n_tokens": pa.array(np.diff(first_word) + 1, pa.int64()),
                "n_known": pa.array((known + (docs > 0)).astype(np.int64)),
                "train_tokens": pa.array(np.full(len(ids), n), pa.int64()),
                "base_score": pa.array(base + np.log10((docs + 1) / (n + v + 1))),
                "score": pa.array(score),
            }
        )

    return run


def score_documents(docs: DataFrame, held: Column, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of all rows, by a model of the rows for which ``held`` is not true."""
    spark = docs.sparkSession
    kind = docs.schema[id_column].dataType.simpleString()

    def stored(df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(spark, label)
        df.write.option("compression", "zstd").parquet(path)
        return spark.read.parquet(path)

    own = docs.select(
        F.col(id_column).alias("id"), F.col(text).alias("text"), F.coalesce(held, F.lit(False)).alias("held")
    )
    size = own.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(1, round((size / BUCKET_SCALE) ** 0.5))
    rows = stored(
        own.mapInArrow(
            _block_rows(buckets),
            "block bigint, kind int, bucket int, keys binary, ns binary, stream binary, size bigint, "
            f"bounds array<bigint>, ids array<{kind}>, held array<boolean>, low array<bigint>, low_ns array<bigint>, "
            "n_train bigint",
        ),
        "blocks",
    )
    texts = rows.filter("kind IS NULL")
    low = (
        texts.select(F.explode(F.arrays_zip("low", "low_ns")).alias("e"))
        .groupBy("e.low")
        .agg(F.sum("e.low_ns").alias("n"))
        .toArrow()
    )
    shared = spark.sparkContext.broadcast((low.column("low").to_numpy(), low.column("n").to_numpy()))

    def by_bucket(of: int) -> DataFrame:
        return rows.filter(F.col("kind") == of).select("block", "kind", "bucket", "keys", "ns").groupBy("bucket")

    words = stored(by_bucket(WORDS).applyInArrow(_word_counts, f"{ANSWERS}, n bigint, v bigint"), "words")
    counted = words.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    n_docs = texts.agg(F.sum("n_train")).first()[0] or 0
    n, v = (counted.n or 0) + n_docs, (counted.v or 0) + (n_docs > 0)
    answers = by_bucket(GRAMS).applyInArrow(_gram_lengths(shared), ANSWERS).unionByName(words.drop("n", "v"))
    # a task takes a block or two, not as many as fall into one of the session's partitions
    parts = 2 * max(1, texts.count())
    return (
        texts.select("block", "stream", "size", "bounds", "ids", "held")
        .repartition(parts, "block")
        .groupBy("block")
        .cogroup(answers.repartition(parts, "block").groupBy("block"))
        .applyInArrow(
            _sum_documents(int(n), int(v), int(n_docs), buckets),
            f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
            "base_score double, score double",
        )
        .withColumnRenamed("id", id_column)
    )


def op1_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    return score_documents(docs, held)


query = op1_ppm
ORACLE_SQL = None
