"""Operator 11: spelling variants by a bit-sliced position index.

Words that differ by one letter share their first half or the rest: of a pair whose
shorter word has m letters, the first m // 2 or the last m - m // 2 letters are equal. So
every word goes to four groups (its length and one less as m, first and last part), and
pairs are found inside groups. Groups of more than ``GROUP`` words are cut into blocks and
every two blocks meet, each in a task of its own; groups are otherwise packed into shards.

A shard holds, for every position and letter, the set of its words with that letter there,
as bits. All words of the shard are then read letter by letter against it. Four sets go
along, 64 words at a time: those equal so far, and those with one letter replaced, one
letter more (they are looked up a position further) or one letter less (a position back).
A pair counts once: in the group of its first part, or else in that of its last part, and
in the groups of its shorter word. Only counts and the best partner leave a shard, never
the pairs.

A word's form has at least ``RATIO`` times its count, so chains of forms have at most
log(largest count) links, and that bounds the rounds of pointer doubling that find roots.

Edge cases: null and empty texts have no words; a null id is the empty string where ids are
hashed; repeated rows count again. Of partners with equal counts the one first in
code-point order is the form. Without words the result is empty. A word is held whole in a
task, as are the words of a group's block. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log, log2

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickflow.session import scratch_path

RUNS = "[a-z\\u00C0-\\u00FF]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHORTEST = 7
LEAST = 2
RATIO = 10

GROUP = 8_192
SHARD = 1_024
SHARD_LETTERS = 1 << 20
QUERIES = 1_024
GROUPS_BROADCAST = 100_000

FOUND = "word string, near bigint, best_n bigint, best string"


def word_counts(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """word and n: runs of letters, one letter taken out of every 31st by its hash."""
    lowered = F.translate(F.col(text), UPPER, LOWER)
    runs = docs.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(lowered, F.lit(f"{RUNS}{{{shortest},}}"), F.lit(0))).alias("run"),
    )
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    words = runs.select("run", h.alias("h")).select(
        F.when(F.col("h") % 31 == 0, cut).otherwise(F.col("run")).alias("word")
    )
    return words.filter(F.char_length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n"))


def groups(words: DataFrame) -> DataFrame:
    """Each word in its groups: shorter length ``m``, group ``key``, and ``head``, the key of
    the word's first part (so ``key = head`` in groups of first parts)."""
    half = (F.col("m") / 2).cast("int")
    first = F.xxhash64(F.lit(0), "m", F.substring("word", F.lit(1), half))
    last = F.xxhash64(F.lit(1), "m", F.substring("word", F.char_length("word") - F.col("m") + half + 1, F.col("m") - half))
    length = F.char_length("word")
    return (
        words.select("word", "n", F.explode(F.array(length, length - 1)).alias("m"))
        .filter("m > 0")
        .select("word", "n", "m", first.alias("head"), last.alias("tail"))
        .select("word", "n", "m", "head", F.explode(F.array("head", "tail")).alias("key"))
    )


def dealt(rows: DataFrame) -> DataFrame:
    """Rows of ``groups`` with their own block and the two blocks that meet."""
    heavy = rows.groupBy("key").agg(F.count("*").alias("size")).filter(F.col("size") > GROUP)
    path = scratch_path(rows.sparkSession, "large-groups")
    heavy.select("key", F.ceil(F.col("size") / (GROUP // 2)).cast("int").alias("blocks")).write.parquet(path)
    heavy = rows.sparkSession.read.parquet(path)
    n_heavy = heavy.count()
    whole = rows.withColumns({c: F.lit(0) for c in ("own", "i", "j")})
    if not n_heavy:
        return whole
    if n_heavy <= GROUPS_BROADCAST:
        heavy = F.broadcast(heavy)  # at most GROUPS_BROADCAST rows of two numbers
    blocks = (
        rows.join(heavy, "key")
        .withColumn("own", F.pmod(F.xxhash64("word"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    )
    return whole.join(heavy.select("key"), "key", "left_anti").unionByName(blocks.select(*whole.columns))


class PositionIndex:
    """For every position and letter the set of words with that letter there, as bits."""

    def __init__(self, words: list[str]):
        self.n = len(words)
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.longest = int(self.lengths.max())
        # a letter more at each end, so that no word ends in a zero
        grid = np.array([f"x{w}x" for w in words]).view(np.uint32).reshape(self.n, -1)[:, 1 : self.longest + 1]
        self.letters, ids = np.unique(grid, return_inverse=True)
        self.ids = ids.reshape(self.n, self.longest).T.copy()
        self.width = -(-self.n // 64)

    def _bits(self, flags: np.ndarray) -> np.ndarray:
        """Rows of flags, one per word, as rows of 64-bit words."""
        whole = np.zeros((len(flags), self.width * 64), bool)
        whole[:, : self.n] = flags
        return np.packbits(whole, axis=1, bitorder="little").view(np.uint64)

    def at(self, position: int) -> np.ndarray:
        """A set for every letter; empty ones outside of all words."""
        flags = np.zeros((len(self.letters), self.n), bool)
        if 0 <= position < self.longest:
            flags[self.ids[position], np.arange(self.n)] = self.lengths > position
        return self._bits(flags)

    def near(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a query (one of the words, by number) and a word that differs by one letter."""
        queries = queries[np.argsort(-self.lengths[queries], kind="stable")]
        own = self.lengths[queries]
        equal = np.repeat(self._bits(np.ones((1, self.n), bool)), len(queries), axis=0)
        replaced, longer, shorter = (np.zeros_like(equal) for _ in range(3))
        back, here, ahead = self.at(-1), self.at(0), self.at(1)
        for position in range(int(own.max(initial=0))):
            live = int(np.searchsorted(-own, -position, "left"))  # those that go on
            letter = self.ids[position, queries[:live]]
            same = here[letter]
            e, r, m, s = (x[:live] for x in (equal, replaced, longer, shorter))
            m |= e
            m &= ahead[letter]
            s &= back[letter]
            s |= e
            r &= same
            r |= e & ~same
            e &= same
            back, here, ahead = here, ahead, self.at(position + 2)
        sizes = np.arange(int(own.max(initial=0)) + 2)
        of_size = self._bits(self.lengths[None, :] == sizes[:, None])
        found = replaced & of_size[own]
        found |= (longer | equal) & of_size[own + 1]
        found |= shorter & of_size[own - 1]
        row, place = np.nonzero(found)
        bits = np.unpackbits(found[row, place].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        which, bit = np.nonzero(bits)
        return queries[row[which]], place[which] * 64 + bit


def best_partners(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Partners of each word within the groups of a shard: their number and the best one."""
    words = table.column("word").to_pylist()
    n, m, head, key, own, i, j = (np.asarray(table.column(c)) for c in ("n", "m", "head", "key", "own", "i", "j"))
    cell = np.unique(np.stack([key, i, j]), axis=1, return_inverse=True)[1].ravel()
    index = PositionIndex(words)
    order = np.empty(len(words), np.int64)
    order[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    for first in range(0, len(words), QUERIES):
        a, b = index.near(np.arange(first, min(len(words), first + QUERIES)))
        kept = (cell[a] == cell[b]) & (np.minimum(index.lengths[a], index.lengths[b]) == m[a])
        kept &= (key[a] == head[a]) | (head[a] != head[b])
        kept &= (i[a] == j[a]) | (own[a] != own[b])
        a, b = a[kept], b[kept]
        ranked = np.lexsort((order[b], -n[b], a))
        a, b = a[ranked], b[ranked]
        heads = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else a
        yield pa.RecordBatch.from_arrays(
            [
                table.column("word").combine_chunks().take(pa.array(a[heads])),
                pa.array(np.diff(np.concatenate([heads, [len(a)]])), pa.int64()),
                pa.array(n[b[heads]], pa.int64()),
                table.column("word").combine_chunks().take(pa.array(b[heads])),
            ],
            ["word", "near", "best_n", "best"],
        )


def _sharded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell, cut into shards between cells."""
    held: list[pa.RecordBatch] = []
    rows = letters = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        rows, letters = table.num_rows, pc.sum(pc.utf8_length(table.column("word"))).as_py()
        while rows > SHARD or letters > SHARD_LETTERS:
            cell = np.stack([np.asarray(table.column(c)) for c in ("key", "i", "j")])
            edges = np.flatnonzero((cell[:, 1:] != cell[:, :-1]).any(axis=0)) + 1
            least = min(SHARD, max(1, rows * SHARD_LETTERS // max(1, letters)))
            edges = edges[edges >= least]
            if not len(edges):
                break
            yield from best_partners(table.slice(0, int(edges[0])))
            table = table.slice(int(edges[0]))
            rows, letters = table.num_rows, pc.sum(pc.utf8_length(table.column("word"))).as_py()
        held = table.to_batches()
    if held:
        yield from best_partners(pa.Table.from_batches(held))


def forms(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``words`` (word, n; distinct words) with n_near, form and form_n."""
    rows = groups(words)
    cells = dealt(rows).repartition("key", "i", "j").sortWithinPartitions("m", "key", "i", "j")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("form")))
    partners = cells.mapInArrow(_sharded, FOUND).groupBy("word").agg(F.sum("near").alias("near"), best.alias("best"))
    frequent = -F.col("best.less") >= ratio * F.col("n")
    return words.join(partners, "word", "left").select(
        "word",
        F.when(frequent, F.col("best.form")).alias("form"),
        "n",
        F.coalesce("near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, -F.col("best.less")).alias("form_n"),
    )


def roots(linked: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word and root of every word with a form, by doubling the links' reach."""
    spark = linked.sparkSession
    most = linked.agg(F.max("form_n")).first()[0] or 1
    links = max(1.0, log(most) / log(ratio))  # each multiplies the count
    found = linked.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(ceil(log2(links)) + 1):
        path = scratch_path(spark, "roots")
        found.write.parquet(path)
        found = spark.read.parquet(path)
        further = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        found = found.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return found


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near and form_n for every row of ``words`` (word, n)."""
    path = scratch_path(words.sparkSession, "forms")
    forms(words, ratio).write.parquet(path)
    linked = words.sparkSession.read.parquet(path)
    return linked.join(roots(linked, ratio), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = scratch_path(spark, "words")
    word_counts(docs).filter(F.col("n") >= LEAST).write.parquet(path)
    return spelling_variants(spark.read.parquet(path))


query = op11_variants
ORACLE_SQL = None
