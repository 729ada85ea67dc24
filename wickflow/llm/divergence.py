"""Operator 13: how far sources diverge, by a recount through minimal perfect hashes.

The first pass counts documents per language and term exactly, and keeps the terms in at
least ``LEAST`` documents of their language. Kept terms are dealt by language and hash to
shards of about ``SHARD_TERMS``. Tasks build a minimal perfect hash of each: bit arrays,
level by level, in which a bit stands for the one term that falls on it; its rank is the
term's slot. Terms themselves are stored by slot, and whatever is looked up is compared
with them byte by byte, so no other word is counted.

Shards are broadcast in rounds of at most ``ROUND_BYTES`` (one more shard at most), each
with a pass over the texts, which adds up dense slots of every group that a task meets and
hands them on when they take more than ``DENSE_BYTES`` or at the end of the partition.

Smoothed shares are whole numbers, computed exactly. Distances of two sources are summed
from blocks of terms as matrices (terms by sources); a source takes part in every block of
its language, with the share of a term it lacks. The report is square in the sources of a
language by its definition, nothing else is.

Edge cases: null texts, languages and sources are the empty string. Repeated rows count as
documents of their own; ids are not looked at. A language without kept terms has distances
of 0 and no term rows; a language of one source has no pairs. An empty table gives an empty
report. Ties go to the item first in UTF-8 order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wickflow.llm.texts import LOWER, Texts, blocks, mixed, ragged_take, span_hashes, words
from wickflow.session import scratch_path

UPPER_CASE, LOWER_CASE = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST = 30
SCALE, PRIOR = 1_000_000_000, 5
TOP = 50

SHARD_TERMS = 1 << 16
BLOCK_TERMS = 4_096
ROUND_BYTES = 64 << 20
DENSE_BYTES = 128 << 20
MATRIX = 4 << 20  # terms x sources of a block
GROUPS_BROADCAST = 100_000

NOT_TERM = np.ones(256, bool)
NOT_TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


# --- minimal perfect hash ------------------------------------------------------


class PerfectHash:
    """Slots 0 to n - 1 of n byte strings, with the strings in the order of their slots."""

    def __init__(self, levels: list[tuple[int, np.ndarray, np.ndarray]], data: np.ndarray, bounds: np.ndarray, rest: dict[bytes, int]):
        self.levels, self.data, self.bounds, self.rest = levels, data, bounds, rest

    @staticmethod
    def _place(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mixed(hashes + np.uint64(level)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: list[bytes], hashes: np.ndarray) -> PerfectHash:
        """Of distinct keys. Those that no level separates, as their hashes are equal, are listed."""
        levels, ordered = [], []
        left, used = np.arange(len(keys)), 0
        while len(left) and len(levels) < 64:
            size = 2 * len(left) + 1
            place = cls._place(hashes[left], len(levels), size)
            alone = np.bincount(place, minlength=size) == 1
            mine = alone[place]
            ranks = used + np.cumsum(alone) - 1  # the slot of each bit
            levels.append((size, np.packbits(alone, bitorder="little"), ranks[::64].astype(np.int64) - alone[::64]))
            chosen = left[mine]
            ordered.extend(chosen[np.argsort(place[mine])].tolist())
            used += len(chosen)
            left = left[~mine]
        rest = {keys[k]: used + i for i, k in enumerate(left.tolist())}
        ordered.extend(left.tolist())
        lengths = np.array([len(keys[k]) for k in ordered], np.int64)
        data = np.frombuffer(b"".join(keys[k] for k in ordered), np.uint8)
        return cls(levels, data, np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64), rest)

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def keys(self) -> list[bytes]:
        data = self.data.tobytes()
        return [data[a:b] for a, b in zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist(), strict=True)]

    def slots(self, hashes: np.ndarray, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Slot of each string ``data[bounds[i]:bounds[i + 1]]``, -1 if it is not a key."""
        slot = np.full(len(hashes), -1, np.int64)
        open_ = np.arange(len(hashes))
        for level, (size, bits, ranks) in enumerate(self.levels):
            place = self._place(hashes[open_], level, size)
            hit = np.flatnonzero((bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1)
            at = place[hit]
            padded = np.concatenate([bits, np.zeros(8, np.uint8)])
            before = np.array([padded[(at >> 6 << 3) + k] for k in range(8)], np.uint8).reshape(8, -1)
            count = ranks[at >> 6].copy()
            for k in range(8):  # bits of this word of 64 up to the place
                upto = np.clip((at & 63) + 1 - 8 * k, 0, 8)
                mask = ((1 << upto) - 1).astype(np.uint8)
                count += np.bitwise_count(before[k] & mask)
            slot[open_[hit]] = count
            open_ = np.delete(open_, hit)
            if not len(open_):
                break
        known = np.flatnonzero(slot >= 0)
        lengths = np.diff(bounds)
        known = known[np.diff(self.bounds)[slot[known]] == lengths[known]]
        stored, heads = ragged_take(self.data, self.bounds, slot[known])
        asked, _ = ragged_take(data, bounds, known)
        differ = np.concatenate([[0], np.cumsum(stored != asked)])
        same = differ[heads[1:]] == differ[heads[:-1]]
        out = np.full(len(hashes), -1, np.int64)
        out[known[same]] = slot[known[same]]
        if self.rest:
            for i in np.flatnonzero(out < 0).tolist():
                out[i] = self.rest.get(data[bounds[i] : bounds[i + 1]].tobytes(), -1)
        return out

    def packed(self) -> dict[str, object]:
        return {
            "sizes": [s for s, _, _ in self.levels],
            "bits": [b.tobytes() for _, b, _ in self.levels],
            "ranks": [r.tobytes() for _, _, r in self.levels],
            "terms": [k.decode() for k in self.keys()],
            "n_rest": len(self.rest),
        }

    @classmethod
    def unpacked(cls, row) -> PerfectHash:
        keys = [t.encode() for t in row.terms]
        levels = [
            (s, np.frombuffer(b, np.uint8), np.frombuffer(r, np.int64))
            for s, b, r in zip(row.sizes, row.bits, row.ranks, strict=True)
        ]
        bounds = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int64)
        first = len(keys) - row.n_rest
        rest = {k: first + i for i, k in enumerate(keys[first:])}
        return cls(levels, np.frombuffer(b"".join(keys), np.uint8), bounds, rest)


SHARD = "lang string, part int, sizes array<bigint>, bits array<binary>, ranks array<binary>, terms array<string>, n_rest int"


def _dealt(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = Texts(batch.column("term"))
            own = span_hashes(texts.data, texts.offsets[:-1], texts.offsets[1:])
            part = (own >> np.uint64(32)) % np.uint64(parts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("term"), pa.array(part.astype(np.int32)), pa.array(own.view(np.int64))],
                ["lang", "term", "part", "hash"],
            )

    return run


def _built(table: pa.Table) -> pa.Table:
    """The perfect hash of a shard."""
    keys = [t.encode() for t in table.column("term").to_pylist()]
    own = PerfectHash.build(keys, table.column("hash").to_numpy().view(np.uint64)).packed()
    lang, part = table.column("lang")[0].as_py(), table.column("part")[0].as_py()
    return pa.table({"lang": [lang], "part": pa.array([part], pa.int32()), **{k: [v] for k, v in own.items() if k != "n_rest"}, "n_rest": pa.array([own["n_rest"]], pa.int32())})


def _recounted(shared, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = {(row.lang, row.part): PerfectHash.unpacked(row) for row in shared.value}
        langs = {lang for lang, _ in shards}
        dense: dict[tuple[str, int, str], np.ndarray] = {}
        taken = 0

        def handed_on() -> Iterator[pa.RecordBatch]:
            for (lang, part, source), counts in dense.items():
                slot = np.flatnonzero(counts)
                if len(slot):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.repeat(lang, len(slot)),
                            pa.array(np.full(len(slot), part, np.int32)),
                            pa.array(slot.astype(np.int32)),
                            pa.repeat(source, len(slot)),
                            pa.array(counts[slot]),
                        ],
                        ["lang", "part", "slot", "source", "n"],
                    )
            dense.clear()

        for batch, texts in blocks(batches, "text"):
            starts, ends, first = words(texts, NOT_TERM)
            data = LOWER[texts.data]
            hashes = span_hashes(data, starts, ends)
            doc = np.repeat(np.arange(len(texts)), np.diff(first))
            doc_langs = np.array(batch.column("lang").to_pylist(), object)
            doc_sources = np.array(batch.column("source").to_pylist(), object)
            names, source_of = np.unique(doc_sources, return_inverse=True)
            for lang in langs & set(doc_langs.tolist()):
                token = np.flatnonzero((doc_langs == lang)[doc])
                distinct, example, which = np.unique(hashes[token], return_index=True, return_inverse=True)
                if not len(distinct):
                    continue
                example = token[example]
                span = np.stack([starts[example], ends[example]], axis=1).ravel()
                part_of = ((distinct >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
                cell = source_of[doc[token]] * len(distinct) + which
                met, count = np.unique(cell, return_counts=True)
                source, term = met // len(distinct), met % len(distinct)
                for part in np.unique(part_of).tolist():
                    if (lang, part) not in shards:
                        continue
                    table = shards[lang, part]
                    mine = np.flatnonzero(part_of == part)
                    asked, bounds = ragged_take(data, span, 2 * mine)
                    slot = np.full(len(distinct), -1, np.int64)
                    slot[mine] = table.slots(distinct[mine], asked, bounds)
                    kept = np.flatnonzero(slot[term] >= 0)
                    for s in np.unique(source[kept]).tolist():
                        key = (lang, part, names[s])
                        if key not in dense:
                            dense[key] = np.zeros(len(table), np.int64)
                            taken += 8 * len(table)
                        own = kept[source[kept] == s]
                        dense[key][slot[term[own]]] += count[own]
            if taken > DENSE_BYTES:
                yield from handed_on()
                taken = 0
        yield from handed_on()

    return run


# --- counts ----------------------------------------------------------------------


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each language and term in a block of texts."""
    for batch, texts in blocks(batches, "text"):
        starts, ends, first = words(texts, NOT_TERM)
        data = LOWER[texts.data]
        distinct, example, which = np.unique(
            span_hashes(data, starts, ends), return_index=True, return_inverse=True
        )
        doc = np.repeat(np.arange(len(texts)), np.diff(first))
        own = np.unique(doc * len(distinct) + which)
        names, lang = np.unique(np.array(batch.column("lang").to_pylist(), object), return_inverse=True)
        cell = lang[own // max(1, len(distinct))] * len(distinct) + own % max(1, len(distinct))
        cell, n = np.unique(cell, return_counts=True)
        at = example[cell % max(1, len(distinct))]
        spans = np.stack([starts, ends], axis=1).ravel()
        flat, bounds = ragged_take(data, spans, 2 * at)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.string()).take(pa.array(cell // max(1, len(distinct)))),
                pa.StringArray.from_buffers(
                    len(at), pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(flat))
                ),
                pa.array(n, pa.int64()),
            ],
            ["lang", "term", "n"],
        )


def kept_terms(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """lang and term of the terms in at least ``least`` documents; ``docs`` has text, lang
    and source without nulls."""
    counted = docs.select("text", "lang").mapInArrow(_document_counts, "lang string, term string, n bigint")
    return (
        counted.groupBy("lang", "term")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= least)
        .select("lang", "term")
    )


def perfect_hashes(kept: DataFrame) -> tuple[DataFrame, int]:
    """A row per shard, and the number of parts that terms of a language are dealt to."""
    parts = max(1, -(-kept.count() // SHARD_TERMS))
    dealt = kept.mapInArrow(_dealt(parts), "lang string, term string, part int, hash bigint")
    return dealt.groupBy("lang", "part").applyInArrow(_built, SHARD), parts


def recount(docs: DataFrame, shards: DataFrame, parts: int) -> DataFrame:
    """n of each (lang, part, slot, source) that occurs."""
    spark = docs.sparkSession
    sizes = shards.select("lang", "part", F.expr("aggregate(terms, 0L, (s, t) -> s + octet_length(t) + 24)").alias("bytes"))
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    rounds = max(1, -(-2 * total // ROUND_BYTES))
    texts = docs.select("text", "lang", "source")
    counts = None
    for turn in range(rounds):
        own = shards.filter(F.pmod(F.xxhash64("lang", "part"), F.lit(rounds)) == turn).collect()
        shared = spark.sparkContext.broadcast(own)
        part = texts.mapInArrow(_recounted(shared, parts), "lang string, part int, slot int, source string, n bigint")
        counts = part if counts is None else counts.unionByName(part)
    return counts.groupBy("lang", "part", "slot", "source").agg(F.sum("n").alias("n"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """One and the floor of the smoothed share, in units of 1 / SCALE."""
    wide = [c.cast("decimal(38,0)") for c in (count, total, terms)]
    top, bottom = (wide[0] + PRIOR) * SCALE, wide[1] + wide[2] * PRIOR
    exact = F.call_function("div", top.cast("decimal(38,0)"), bottom.cast("decimal(38,0)"))
    return (exact + 1).cast("long")


def _distances(table: pa.Table) -> pa.Table:
    """Sums over a block of terms of the differences of every two sources."""
    lang = table.column("lang")[0].as_py()
    term, p, n = (table.column(c).to_numpy(zero_copy_only=False) for c in ("term_no", "p", "n"))
    sources, source = np.unique(np.array(table.column("source").to_pylist(), object), return_inverse=True)
    base = np.zeros(len(sources), np.int64)
    base[source[n == 0]] = p[n == 0]
    met = np.flatnonzero(n > 0)
    terms, row = np.unique(term[met], return_inverse=True)
    matrix = np.repeat(base[:, None], len(terms), axis=1)
    matrix[source[met], row] = p[met]
    values = np.concatenate([np.abs(matrix - own).sum(axis=1) for own in matrix])
    return pa.table(
        {
            "lang": pa.repeat(lang, len(values)),
            "source": pa.array(np.repeat(sources, len(sources)), pa.string()),
            "item": pa.array(np.tile(sources, len(sources)), pa.string()),
            "value": pa.array(values, pa.int64()),
        }
    )


def divergence(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value and rank: distances to the other sources of the
    language, and the terms that are most above the language's share."""
    docs = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("text", "lang", "source")))
    kept = _stored(kept_terms(docs, least), "kept-terms")
    built, parts = perfect_hashes(kept)
    shards = _stored(built, "perfect-hashes")
    counts = _stored(recount(docs, shards, parts), "recount")

    slot, group = ["lang", "part", "slot"], ["lang", "source"]
    v = kept.groupBy("lang").agg(F.count("*").alias("v"))
    totals = counts.groupBy(*group).agg(F.sum("n").alias("total"))
    groups = docs.select(*group).distinct().join(totals, group, "left").join(v, "lang", "left")
    groups = _stored(groups.fillna(0), "groups")
    small = F.broadcast if groups.count() <= GROUPS_BROADCAST else (lambda df: df)  # rows of two names
    with_terms = groups.filter("v > 0")

    # pairs
    most = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 1
    width = max(16, min(BLOCK_TERMS, MATRIX // most))
    block = [*slot[:2], "block"]
    shares = counts.join(small(with_terms), group).select(
        *slot, "source", "n", share(F.col("n"), F.col("total"), F.col("v")).alias("p")
    )
    met = shares.select(
        *slot[:2], F.floor(F.col("slot") / width).cast("int").alias("block"), "source", F.col("slot").alias("term_no"), "p", "n"
    )
    zero = F.lit(0).cast("long")
    absent = met.select(*block).distinct().join(small(with_terms), "lang").select(
        *block, "source", F.lit(-1).alias("term_no"), share(zero, F.col("total"), F.col("v")).alias("p"), zero.alias("n")
    )
    sums = (
        met.unionByName(absent)
        .groupBy(*block)
        .applyInArrow(_distances, "lang string, source string, item string, value bigint")
        .groupBy(*group, "item")
        .agg(F.sum("value").alias("value"))
    )
    others = groups.select("lang", F.col("source").alias("item"))
    pairs = (
        groups.select(*group)
        .join(others, "lang")
        .filter(F.col("source") != F.col("item"))
        .join(sums, [*group, "item"], "left")
        .select(*group, F.lit("pair").alias("kind"), "item", F.coalesce("value", zero).alias("value"))
    )

    # terms
    of_lang = counts.groupBy(*slot).agg(F.sum("n").alias("n_lang"))
    lang_total = totals.groupBy("lang").agg(F.sum("total").alias("lang_total")).join(v, "lang")
    q = of_lang.join(small(lang_total), "lang").select(
        *slot, share(F.col("n_lang"), F.col("lang_total"), F.col("v")).alias("q")
    )
    names = shards.select("lang", "part", F.posexplode("terms").alias("slot", "item"))
    above = (
        shares.join(q, slot)
        .filter("p > q")
        .join(names, slot)
        .select(*group, F.lit("term").alias("kind"), "item", (F.col("p") - F.col("q")).alias("value"))
    )
    order = Window.partitionBy(*group).orderBy(F.desc("value"), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).unionByName(
        above.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    )
    return ranked.withColumnRenamed("kind", "part").select(*group, "part", "item", "value", "rank")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(spark.read.parquet(f"{sf_dir}/documents.parquet"))


query = op13_divergence
ORACLE_SQL = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
        coalesce(source, '') AS source
    FROM documents
), tokens AS (
    SELECT r, lang, source, unnest(regexp_extract_all(
        translate(text, '{UPPER_CASE}', '{LOWER_CASE}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM docs
), kept AS (
    SELECT lang, term FROM tokens GROUP BY 1, 2 HAVING count(DISTINCT r) >= {LEAST}
), counts AS (
    SELECT lang, source, term, count(*) AS n FROM tokens JOIN kept USING (lang, term) GROUP BY 1, 2, 3
), sources AS (
    SELECT DISTINCT lang, source FROM docs
), dense AS (
    SELECT s.lang, s.source, k.term, coalesce(n, 0) AS n
    FROM sources s JOIN kept k ON s.lang = k.lang
    LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), of_lang AS (
    SELECT lang, term, sum(n) AS n FROM dense GROUP BY 1, 2
), p AS (
    SELECT lang, source, term, n, 1 + ({SCALE} * (n + {PRIOR})::HUGEINT)
        // (sum(n) OVER own + {PRIOR} * count(*) OVER own) AS p
    FROM dense WINDOW own AS (PARTITION BY lang, source)
), q AS (
    SELECT lang, term, 1 + ({SCALE} * (n + {PRIOR})::HUGEINT)
        // (sum(n) OVER own + {PRIOR} * count(*) OVER own) AS q
    FROM of_lang WINDOW own AS (PARTITION BY lang)
), distances AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY 1, 2, 3
), listed AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN distances d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
    UNION ALL
    SELECT p.lang, source, 'term', p.term, p - q
    FROM p JOIN q ON p.lang = q.lang AND p.term = q.term
    WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM listed
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
