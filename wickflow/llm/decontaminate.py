"""Operator 8: benchmark decontamination by suffix arrays of training shards.

A shard is a block of documents (``BLOCK_BYTES`` of text, or one longer text) inside a
task. Its words are numbered by the words of the test items, and the suffixes that can
begin a match (those whose first words begin some test suffix) are sorted by their next
``WINDOW`` words. All test suffixes are then searched at once: one binary search per
word narrows each suffix's interval, and what remains are the places of its window.
Matches are extended word by word to their full length. A document never leaves its
row, so nothing is shuffled.

Test items are taken in blocks of at most ``ITEM_BYTES`` of text, each broadcast in
turn, and every block passes over all documents; what a row has gathered travels with it
to the next block. Words are compared by a 64-bit hash.

Edge cases: a null or empty text has no words and no hits; an item without words matches
nothing; an item shorter than the window is one window of its own length. Rows that
repeat an item id count as that item once per document; null ids are one item, whose name
is empty. Repeated documents are judged one
by one. Other columns travel in a struct, so their names cannot clash.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickflow.llm.columns import apart
from wickflow.llm.texts import LOWER, NOT_ALNUM, Texts, blocks, mixed, span_hashes, words

WINDOW = 10
ITEM_BYTES = 4 << 20
BLOCK_BYTES = 2 << 20
SIEVE_BITS = 20
_MASK = np.uint64((1 << SIEVE_BITS) - 1)


def word_hashes(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = words(texts, NOT_ALNUM)
    return span_hashes(LOWER[texts.data], starts, ends), first


def gram_codes(tokens: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """A hash of the ``n`` tokens that begin at each position."""
    code = np.zeros(len(at), np.uint64)
    for k in range(n):
        code = mixed(code + tokens[at + k].astype(np.uint64) + np.uint64(k + 1))
    return code


class TestSet:
    """The distinct windows of a block of items, ready to be searched in shards."""

    __test__ = False

    def __init__(self, ids: list, texts: list[str | None], window: int = WINDOW):
        hashes, first = word_hashes(Texts(pa.array(texts, pa.string())))
        self.window = window
        self.vocabulary = np.unique(hashes)
        numbers = np.searchsorted(self.vocabulary, hashes) + 1
        owners = defaultdict(set)
        for i, item in enumerate(ids):
            own = tuple(numbers[first[i] : first[i + 1]].tolist())
            width = min(window, len(own))
            for at in range(len(own) - width + 1 if own else 0):
                owners[own[at : at + width]].add((item, i, at))
        self.keys = sorted(owners)
        self.places = [sorted({(i, at) for _, i, at in owners[k]}) for k in self.keys]
        self.items = [sorted({item for item, _, _ in owners[k]}, key=str) for k in self.keys]
        self.lengths = np.array([len(k) for k in self.keys], np.int64)
        self.grid = np.zeros((len(self.keys), window), np.int64)
        for row, key in enumerate(self.keys):
            self.grid[row, : len(key)] = key
        self.numbers = [numbers[first[i] : first[i + 1]] for i in range(len(ids))]
        self.head = int(min(3, self.lengths.min())) if self.keys else 0
        self.words = self._sieve(self.vocabulary)
        tokens = self.grid.ravel()
        self.heads = self._sieve(gram_codes(tokens, np.arange(len(self.keys)) * window, self.head))

    @staticmethod
    def _sieve(codes: np.ndarray) -> np.ndarray:
        sieve = np.zeros(1 << SIEVE_BITS, bool)
        sieve[codes & _MASK] = True
        return sieve

    def numbered(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of test words, 0 for other words."""
        out = np.zeros(len(hashes), np.int64)
        maybe = np.flatnonzero(self.words[hashes & _MASK])
        at = np.searchsorted(self.vocabulary, hashes[maybe])
        at[at == len(self.vocabulary)] = 0
        same = self.vocabulary[at] == hashes[maybe]
        out[maybe[same]] = at[same] + 1
        return out


class Shard:
    """A suffix array over the words of a block of documents.

    ``tokens`` has a 0 after each document, which matches no test word.
    """

    def __init__(self, tests: TestSet, texts: Texts):
        hashes, self.first = word_hashes(texts)
        counts = np.diff(self.first)
        owner = np.repeat(np.arange(len(texts)), counts)
        self.starts = self.first[:-1] + np.arange(len(texts))
        self.tokens = np.zeros(len(hashes) + len(texts) + tests.window, np.int64)
        place = np.arange(len(hashes)) + owner
        self.tokens[place] = tests.numbered(hashes)
        at = np.flatnonzero(self.tokens)
        for n in range(2, tests.head + 1):
            at = at[self.tokens[at + n - 1] > 0]
        at = at[tests.heads[gram_codes(self.tokens, at, tests.head) & _MASK]]
        columns = [self.tokens[at + k] for k in range(tests.window)]
        # numbers after a 0 belong to no match of this suffix
        for k in range(1, tests.window):
            columns[k] = np.where(columns[k - 1] > 0, columns[k], 0)
        order = np.lexsort(columns[::-1]) if len(at) else np.empty(0, np.int64)
        self.suffixes = at[order]
        self.columns = [c[order] for c in columns]

    def search(self, tests: TestSet) -> tuple[np.ndarray, np.ndarray]:
        """For each test window the interval of suffixes that begin with it."""
        low = np.zeros(len(tests.keys), np.int64)
        high = np.full(len(tests.keys), len(self.suffixes), np.int64)
        for k, column in enumerate(self.columns):
            live = np.flatnonzero((low < high) & (tests.lengths > k))
            if not len(live):
                break
            wanted = tests.grid[live, k]
            low[live], high[live] = (
                bisect(column, wanted, low[live], high[live], side) for side in (False, True)
            )
        return low, high


def bisect(column: np.ndarray, wanted: np.ndarray, low: np.ndarray, high: np.ndarray, right: bool) -> np.ndarray:
    """Binary search of each wanted value in its own interval of the column."""
    low, high = low.copy(), high.copy()
    while len(open_ := np.flatnonzero(low < high)):
        middle = (low[open_] + high[open_]) >> 1
        value = column[middle]
        below = value <= wanted[open_] if right else value < wanted[open_]
        low[open_] = np.where(below, middle + 1, low[open_])
        high[open_] = np.where(below, high[open_], middle)
    return low


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def longest_match(tests: TestSet, shard: Shard, place: int, key: int) -> int:
    """Words of the longest match through this place; 0 if it began further left."""
    best = 0
    for item, at in tests.places[key]:
        own, n = tests.numbers[item], int(tests.lengths[key])
        if at and place and shard.tokens[place - 1] == own[at - 1]:
            continue
        while at + n < len(own) and shard.tokens[place + n] == own[at + n]:
            n += 1
        best = max(best, n)
    return best


def matches(tests: TestSet, texts: Texts) -> tuple[np.ndarray, dict[int, tuple[list, set, int]]]:
    """Words of each text, and for texts with hits: merged spans of words, the items
    and the length of the longest match."""
    shard = Shard(tests, texts)
    found: dict[int, tuple[list, set, int]] = {}
    low, high = shard.search(tests)
    for key in np.flatnonzero(low < high):
        places = np.sort(shard.suffixes[low[key] : high[key]])
        docs = np.searchsorted(shard.starts, places, "right") - 1
        for doc, place in zip(docs.tolist(), places.tolist(), strict=True):
            spans, items, longest = found.get(doc, ([], set(), 0))
            start = place - int(shard.starts[doc])
            spans.append((start, start + int(tests.lengths[key])))
            items.update(tests.items[key])
            found[doc] = (spans, items, max(longest, longest_match(tests, shard, place, key)))
    return np.diff(shard.first), {d: (merged(s), i, n) for d, (s, i, n) in found.items()}


def find_matches(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    columns: list[str] | None = None,
) -> DataFrame:
    """``columns`` of the rows (default: all) as the struct ``row``, with ``n_words``, ``spans`` of matched words
    (start and end), the matched ``items`` and the words of the ``longest`` match."""
    spark = docs.sparkSession
    kind = items.schema[item_id].dataType.simpleString()
    packed, row = apart(docs, text, columns)
    schema = (
        f"rest {packed.schema['rest'].dataType.simpleString()}, text string, n_words bigint, "
        f"spans array<struct<start:bigint,end:bigint>>, items array<{kind}>, longest bigint"
    )
    tests = items.select(F.col(item_id).alias("id"), F.col(item_text).alias("text")).filter("text <> ''")
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // ITEM_BYTES))
    found = packed.selectExpr(
        "rest",
        "text",
        "CAST(0 AS BIGINT) AS n_words",
        "CAST(array() AS array<struct<start:bigint,end:bigint>>) AS spans",
        f"CAST(array() AS array<{kind}>) AS items",
        "CAST(0 AS BIGINT) AS longest",
    )
    for block in range(n):
        own = tests.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == block).collect()
        shared = spark.sparkContext.broadcast(TestSet([r.id for r in own], [r.text for r in own]))
        found = found.mapInArrow(_searched(shared), schema)
    return found.select(row.alias("row"), "n_words", "spans", "items", "longest")


def _searched(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in blocks(batches, "text", BLOCK_BYTES):
            counts, found = matches(shared.value, texts)
            columns = {name: part.column(name) for name in part.schema.names}
            columns["n_words"] = pa.array(counts, pa.int64())
            if found:
                spans, items, longest = (part.column(c).to_pylist() for c in ("spans", "items", "longest"))
                for doc, (own, own_items, n) in found.items():
                    both = merged([*own, *((s["start"], s["end"]) for s in spans[doc])])
                    spans[doc] = [{"start": a, "end": b} for a, b in both]
                    items[doc] = list({*items[doc], *own_items})
                    longest[doc] = max(longest[doc], n)
                for name, values in (("spans", spans), ("items", items), ("longest", longest)):
                    columns[name] = pa.array(values, part.schema.field(name).type)
            yield pa.RecordBatch.from_pydict(columns)

    return run


def digests(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id and what was found in the text, as numbers and a digest of the items' ids."""
    found = find_matches(docs, items, columns=["doc_id"])
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    names = F.transform("items", lambda i: F.coalesce(i.cast("string"), F.lit("")))
    return found.select(
        "row.doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array(names), ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
        F.col("longest").alias("longest_match"),
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digests(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


query = op8_decontamination
_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
ORACLE_SQL = f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents
), items AS (
    SELECT row_number() OVER () AS i, coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS w FROM benchmark
), item_windows AS (
    SELECT i, item, pos, n, array_to_string(w[pos:pos + n - 1], ' ') AS win
    FROM (SELECT *, least({WINDOW}, len(w)) AS n, unnest(range(1, greatest(1, len(w) - {WINDOW - 1}) + 1)) AS pos
          FROM items WHERE len(w) > 0)
), doc_windows AS (
    SELECT r, pos, n, array_to_string(w[pos:pos + n - 1], ' ') AS win
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS pos
          FROM docs, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)
), hits AS (
    SELECT r, d.pos, d.n, i, item, d.pos - i.pos AS diagonal
    FROM doc_windows d JOIN item_windows i ON d.n = i.n AND d.win = i.win
), covered AS (
    SELECT r, count(DISTINCT pos + k) AS n_hit FROM hits, range({WINDOW}) AS t(k) WHERE k < n GROUP BY r
), matched AS (
    SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM hits GROUP BY r
), runs AS (
    SELECT r, max(words) AS longest FROM (
        SELECT r, count(*) + any_value(n) - 1 AS words FROM (
            SELECT *, pos - row_number() OVER (PARTITION BY r, i, diagonal ORDER BY pos) AS run FROM hits
        ) GROUP BY r, i, diagonal, run
    ) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
    n_hit IS NOT NULL AS contaminated, CAST(coalesce(longest, 0) AS BIGINT) AS longest_match
FROM docs LEFT JOIN covered USING (r) LEFT JOIN matched USING (r) LEFT JOIN runs USING (r)
"""
