"""Operator 7: URL rules by a sort-merge range join.

A host is keyed by its reversed labels (``com.example.www.``), so a rule's host and
all its subdomains form one interval of keys. URLs and rules are cut into ranges of
that key, sorted, and swept once; the sweep keeps a stack of the intervals it is
inside. Nested intervals are nested domains, so the top of the stack is the longest
host. Within an entry the longest rule path that the URL's path starts with wins.

Ranges are cut at (host key, path, row hash), so that one hot host spreads over many
ranges; a rule goes to every range its interval meets. Boundaries come from a sample
whose size is proportional to the number of ranges (``RANGES`` at most); they decide
balance only, never the result. A sweep streams its sorted rows and holds one stack.

Edge cases: a null URL, or one without ``://``, has an empty host and path and fits no
rule but one of an empty host. Repeated rows are judged one by one. Of rules with equal
host and path the first in order of verdict holds (``allow`` before ``block``). Columns
other than the id and the URL are not read, so their names cannot clash.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the query: host, path, verdict.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

RANGES = 4096
ROWS_PER_RANGE = 250_000
SAMPLE_PER_RANGE = 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def host_key(host: Column) -> Column:
    reversed_labels = F.array_join(F.reverse(F.split(host, r"\.", -1)), ".")
    return F.when(host == "", "").otherwise(F.concat(reversed_labels, F.lit(".")))


def boundaries(keyed: DataFrame) -> list[tuple[bytes, bytes, int]]:
    """Where ranges begin, but for the first: at most ``RANGES`` - 1 keys."""
    ranges = min(RANGES, -(-keyed.count() // ROWS_PER_RANGE))
    if ranges < 2:
        return []
    drawn = keyed.select("key", "path", "tie").orderBy("tie").limit(ranges * SAMPLE_PER_RANGE)
    found = sorted((r.key.encode(), r.path.encode(), r.tie) for r in drawn.collect())
    step = len(found) / ranges
    return sorted({found[int(i * step)] for i in range(1, ranges)})


def _range_of_url(bounds: list):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("key", "path", "tie")), strict=True)
            at = [bisect_right(bounds, (k.encode(), p.encode(), t)) for k, p, t in keys]
            yield batch.append_column("part", pa.array(at, pa.int32()))

    return run


def _ranges_of_rule(bounds: list):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for key in batch.column("key").to_pylist():
                first = bisect_right(bounds, (key.encode(), b"", -(1 << 63)))
                last = bisect_right(bounds, (key.encode() + b"\xff",)) if key else len(bounds)
                spans.append(list(range(first, last + 1)))
            yield batch.append_column("parts", pa.array(spans, pa.list_(pa.int32())))

    return run


class Stack:
    """Open intervals of host keys, outermost first, with their rules by path."""

    def __init__(self) -> None:
        self.open: list[tuple[str, dict[str, tuple[str, str]], list[int]]] = []

    def close_before(self, key: str) -> None:
        while self.open and not key.startswith(self.open[-1][0]):
            self.open.pop()

    def add(self, key: str, path: str, rule: str, verdict: str) -> None:
        self.close_before(key)
        if not self.open or self.open[-1][0] != key:
            self.open.append((key, {}, []))
        _, rules, lengths = self.open[-1]
        rules.setdefault(path, (rule, verdict))
        if len(path) not in lengths:
            lengths.append(len(path))
            lengths.sort(reverse=True)

    def judge(self, key: str, path: str) -> tuple[str | None, str | None]:
        self.close_before(key)
        for _, rules, lengths in reversed(self.open):
            for n in lengths:
                if n <= len(path) and (found := rules.get(path[:n])):
                    return found
        return None, None


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, stack = None, Stack()
    for batch in batches:
        rules, verdicts = [], []
        columns = ("part", "is_url", "key", "path", "rule", "verdict")
        for p, is_url, key, path, rule, verdict in zip(
            *(batch.column(c).to_pylist() for c in columns), strict=True
        ):
            if p != part:
                part, stack = p, Stack()
            if is_url:
                rule, verdict = stack.judge(key, path)
            else:
                stack.add(key, path, rule, verdict)
            rules.append(rule)
            verdicts.append(verdict)
        kept = batch.select(["is_url", "id", "host", "path"])
        yield kept.append_column("rule", pa.array(rules, pa.string())).append_column(
            "verdict", pa.array(verdicts, pa.string())
        )


def judge_urls(
    urls: DataFrame,
    rules: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    default: str = "allow",
) -> DataFrame:
    """id, host, path, the rule that wins (null without one) and its verdict, for each row.

    ``rules`` has the columns host, path and verdict; there may be any number of them.
    """
    host, path = url_parts(F.col("url"))
    keyed = (
        urls.select(F.col(id_column).alias("id"), F.col(url_column).alias("url"))
        .select("id", host.alias("host"), path.alias("path"))
        .withColumn("key", host_key(F.col("host")))
        .withColumn("tie", F.xxhash64("id"))
    )
    bounds = boundaries(keyed)
    kind = urls.schema[id_column].dataType.simpleString()
    dealt = keyed.mapInArrow(
        _range_of_url(bounds),
        f"id {kind}, host string, path string, key string, tie bigint, part int",
    )
    rule_host = F.translate("host", UPPER, LOWER)
    interval = rules.filter("host IS NOT NULL AND path IS NOT NULL").select(
        host_key(rule_host).alias("key"),
        "path",
        F.concat(rule_host, F.col("path")).alias("rule"),
        "verdict",
    )
    placed = interval.mapInArrow(
        _ranges_of_rule(bounds),
        "key string, path string, rule string, verdict string, parts array<int>",
    ).select("*", F.explode("parts").alias("part"))
    swept = (
        dealt.withColumn("is_url", F.lit(True))
        .unionByName(placed.drop("parts").withColumn("is_url", F.lit(False)), True)
        .repartition(len(bounds) + 1, "part")
        .sortWithinPartitions("part", "key", "is_url", "path", "verdict")
        .select("part", "is_url", "id", "host", "key", "path", "rule", "verdict")
        .mapInArrow(
            _sweep,
            f"is_url boolean, id {kind}, host string, path string, rule string, verdict string",
        )
    )
    return swept.filter("is_url").select(
        F.col("id").alias(id_column),
        "host",
        "path",
        "rule",
        F.coalesce("verdict", F.lit(default)).alias("verdict"),
    )


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules)


query = op7_url_rules

ORACLE_SQL = f"""
WITH cut AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0
        THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
    SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut
), parts AS (
    SELECT page_id, translate(raw, '{UPPER}', '{LOWER}') AS host,
           regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM split
), rules(host, path, verdict) AS (VALUES {", ".join(str(r) for r in RULES)}),
fits AS (
    SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
           row_number() OVER (PARTITION BY p.page_id
               ORDER BY length(r.host) DESC, length(r.path) DESC) AS nth
    FROM parts p LEFT JOIN rules r ON starts_with(p.path, r.path)
        AND (p.host = r.host OR ends_with(p.host, '.' || r.host))
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE nth = 1
"""
