"""Operator 4: quality rules, a threshold table compiled into one projection.

``RULES`` holds a numerator, a denominator and the percentages between which their
ratio has to lie; ``compiled`` turns the rows into one boolean column of built-in
functions. Nothing is shuffled and no user function runs. Ratios are compared in
integers (100 * numerator against percentage * denominator), so that engines agree.

Words are runs of characters other than space and tab to carriage return. A window is
five words in a row; a word counts as repeated if any window that holds it occurs twice
or more in the text. Windows are compared by a chained 64-bit hash of their words, and
only texts with two equal hashes pay for the search of the covered words.

Edge cases: a null or empty text has no words, fails the base and is not kept. A rule
whose denominator is zero holds. Repeated rows are judged one by one; other columns are
kept as they are, and a clashing name of a measure is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickflow.llm.columns import once

BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
WINDOW = 5

# Frequent function words of the four languages.
STOP_WORDS = [
    *("the", "of", "and", "to", "in", "is", "a", "that", "for", "it", "as", "was", "with", "be"),
    *("der", "die", "das", "und", "ist", "von", "den", "mit", "zu", "ein", "eine", "nicht"),
    *("de", "la", "le", "les", "et", "des", "que", "un", "une", "du", "pas", "pour", "dans"),
    *("el", "los", "las", "y", "en", "por", "con", "una", "se", "su", "no", "es", "del"),
]

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """``low`` <= 100 * numerator / denominator <= ``high``, for texts of ``least`` words or more."""

    name: str
    numerator: str
    denominator: str
    low: int | None = None
    high: int | None = None
    least: int = 0


BASE = [
    Rule("enough words", "n_words", "1", low=1000),
    Rule("few repeated windows", "n_repeat_words", "n_words", high=20),
]

RULES = [
    Rule("mean word length", "word_chars", "n_words", low=200, high=1500),
    Rule("symbols per word", "n_symbols", "n_words", high=10),
    Rule("exclamation marks per word", "n_shouts", "n_words", high=10),
    Rule("capital letters", "n_capitals", "word_chars", high=30),
    Rule("repeated lines", "n_dup_lines", "n_lines", high=50),
    Rule("stop words", "n_stop_words", "n_words", low=1, least=200),
]


def condition(rule: Rule) -> str:
    """SQL that is true where the rule is broken; the same text runs in DuckDB."""
    parts = []
    if rule.low is not None:
        parts.append(f"100 * {rule.numerator} < {rule.low} * {rule.denominator}")
    if rule.high is not None:
        parts.append(f"100 * {rule.numerator} > {rule.high} * {rule.denominator}")
    return f"(n_words >= {rule.least} AND {rule.denominator} > 0 AND ({' OR '.join(parts)}))"


def compiled(rules: list[Rule]) -> str:
    return " OR ".join(condition(rule) for rule in rules)


def repeated_words() -> Column:
    """Words inside windows whose hash occurs twice or more in ``windows``."""
    return F.expr(
        f"""
        CASE WHEN size(array_distinct(windows)) = size(windows) THEN 0 ELSE
        aggregate(
            transform(
                array(sort_array(flatten(transform(
                    array(array_sort(transform(windows, (h, i) -> struct(h AS h, i AS i)))),
                    s -> transform(
                        filter(s, (x, j) -> x.h = get(s, j - 1).h OR x.h = get(s, j + 1).h),
                        x -> x.i
                    )
                )))),
                p -> aggregate(
                    transform(p, (x, j) -> least({WINDOW}, coalesce(get(p, j + 1) - x, {WINDOW}))),
                    0, (total, x) -> total + x
                )
            ), 0, (total, x) -> total + x
        ) END
        """
    )


def with_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with the columns that rules may name."""
    body = F.coalesce(F.col(text), F.lit(""))
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    chained = ", ".join(f"get(_words, i + {k})" for k in range(WINDOW))
    return (
        docs.withColumn("_text", body)
        .withColumn("_words", F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)))
        .withColumn(
            "_lines", F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        )
        .withColumn("n_words", F.size("_words").cast("long"))
        .withColumn(
            "windows",
            F.expr(
                f"""CASE WHEN n_words < {WINDOW} THEN array() ELSE
                transform(sequence(0, CAST(n_words AS INT) - {WINDOW}), i -> xxhash64({chained})) END"""
            ),
        )
        .withColumn("word_chars", (F.length("_text") - F.regexp_count("_text", F.lit(BLANK))).cast("long"))
        .withColumn("n_symbols", F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long"))
        .withColumn("n_lines", F.size("_lines").cast("long"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("n_repeat_words", repeated_words().cast("long"))
        .withColumn("n_shouts", F.regexp_count("_text", F.lit("!")).cast("long"))
        .withColumn("n_capitals", F.regexp_count("_text", F.lit("[A-Z]")).cast("long"))
        .withColumn(
            "n_stop_words",
            F.expr(f"size(filter(_words, w -> lower(w) IN ({stop})))").cast("long"),
        )
        .drop("_text", "_words", "_lines", "windows")
    )


def judge(docs: DataFrame, text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """The documents with their measures, ``base_failed`` and ``kept``."""
    return (
        with_measures(docs, text)
        .withColumn("base_failed", F.expr(compiled(BASE)))
        .withColumn("kept", ~F.col("base_failed") & ~F.expr(compiled(rules)))
    )


def filter_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows that the rules keep, with the columns they came with."""
    judged = judge(docs.select(F.struct("*").alias("row"), F.col(text).alias("text")))
    return once(judged.select("row", "kept"), "stays", F.col("kept")).filter("stays").select("row.*")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return judge(docs).select("doc_id", *MEASURES, "base_failed", "kept")


query = op4_quality_rules

# Measures of ``documents`` in DuckDB, shared with the pipeline's SQL.
MEASURES_SQL = f"""
SELECT d.*, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) AS BIGINT) AS n_lines,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce((
        SELECT count(DISTINCT pos + k) FROM (
            SELECT pos, count(*) OVER (PARTITION BY win) AS n FROM (
                SELECT unnest(range(1, len(w) - {WINDOW - 2})) AS pos,
                       unnest(list_transform(range(1, len(w) - {WINDOW - 2}),
                              lambda i: array_to_string(w[i:i + {WINDOW - 1}], ' '))) AS win
            )
        ), range({WINDOW}) AS r(k) WHERE n > 1
    ), 0) AS BIGINT) AS n_repeat_words,
    CAST(length(regexp_replace(t, '[^!]', '', 'g')) AS BIGINT) AS n_shouts,
    CAST(length(regexp_replace(t, '[^A-Z]', '', 'g')) AS BIGINT) AS n_capitals,
    CAST(len(list_filter(w, lambda x: lower(x) IN ({", ".join(f"'{s}'" for s in STOP_WORDS)}))) AS BIGINT)
        AS n_stop_words
FROM (
    SELECT *, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)),
                    lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
    FROM {{documents}}
) d
"""

ORACLE_SQL = f"""
WITH measured AS ({MEASURES_SQL.replace("{documents}", "documents")})
SELECT doc_id, {", ".join(MEASURES)}, {compiled(BASE)} AS base_failed,
    NOT ({compiled(BASE)}) AND NOT ({compiled(RULES)}) AS kept
FROM measured
"""
