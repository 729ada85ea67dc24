"""Operator 5: license scans with MinHash bands, in DataFrame functions only.

Words are lower-cased runs of letters, digits and non-ASCII; shingles are five words,
hashed to 64 bits. For each template length L a text has overlapping windows of
L + step words, one every ``step`` = L / 4 words, so any place of the template lies whole
within a window. A window and a template are compared by ``BANDS`` MinHash values, one
to a band. A window that holds 0.8 of a template's shingles has a Jaccard similarity of
1/3 or more with it, so at least one of 32 bands agrees with a probability above
1 - (2/3)^32 = 0.999997. What the bands retrieve is verified by the exact share of the
template's shingles in the window.

Windows without any shingle of a template cannot reach the share and are dropped before
they are hashed (an exact test against a set of hashes); most texts end there, in the
scan. Templates are broadcast up to ``MOST_BROADCAST`` shingles, so windows are banded and
verified where their text was read, and only matches are shuffled.

Edge cases: null or empty texts, and texts of fewer than five words, have no shingles and
no result. A template of fewer than five words raises an error. Rows that repeat an id
count as one document. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickflow.llm.columns import once

WORDS = 5
SHARE = 80  # per cent
BANDS = 32
MOST_BROADCAST = 1 << 20  # template shingles times bands; beyond, the join shuffles windows
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Usual license lines and notices.
TEMPLATES = [
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    (
        "Apache-2.0 notice",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
        "in compliance with the License. You may obtain a copy of the License at",
    ),
    (
        "MIT notice",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software",
    ),
    (
        "GPL notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation",
    ),
    (
        "BSD notice",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met",
    ),
]


def shingled(df: DataFrame, text: str) -> DataFrame:
    """``n_words`` and the hashes of all shingles, in order."""
    chained = ", ".join(f"get(own_words, i + {k})" for k in range(WORDS))
    own = once(df, "own_words", F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0)))
    hashes = F.expr(
        f"""CASE WHEN size(own_words) >= {WORDS}
        THEN transform(sequence(0, size(own_words) - {WORDS}), i -> xxhash64({chained}))
        ELSE CAST(array() AS array<bigint>) END"""
    )
    return once(own.withColumn("n_words", F.size("own_words")), "shingles", hashes).drop("own_words")


def signature(shingles: str) -> Column:
    """The MinHash value of each band, with its number."""
    return F.expr(
        f"""transform(sequence(0, {BANDS - 1}),
            b -> struct(b AS band, array_min(transform({shingles}, x -> xxhash64(x, b))) AS low))"""
    )


def scan(docs: DataFrame, templates: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id, license, the largest ``containment``, the windows that reach 0.8 (``n_windows``)
    and the word at which the first of them begins, for each document and template.

    ``templates`` has the columns license and body; their shingles must fit into an IN list.
    """
    known = shingled(templates, "body").withColumn("shingles", F.array_distinct("shingles")).collect()
    if short := [row.license for row in known if not row.shingles]:
        raise ValueError(f"templates of fewer than {WORDS} words: {short}")
    every = sorted({x for row in known for x in row.shingles})
    wanted = docs.sparkSession.createDataFrame(
        [(r.license, r.n_words, r.shingles) for r in known], "license string, length int, own array<bigint>"
    )
    lengths = sorted({row.n_words for row in known})
    own = shingled(docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")), "text")
    found = once(own, "marks", F.transform("shingles", lambda x: x.isin(every)))
    hits = found.filter(F.exists("marks", lambda m: m)).select("id", "shingles", "marks")
    windows = F.flatten(
        F.array(
            *[
                F.expr(
                    f"""transform(sequence(0, size(shingles) - 1, {step}), s -> struct({n} AS length, s AS start,
                    slice(shingles, s + 1, {n + step - WORDS + 1}) AS window,
                    exists(slice(marks, s + 1, {n + step - WORDS + 1}), m -> m) AS marked))"""
                )
                for n in lengths
                for step in [-(-n // 4)]
            ]
        )
    )
    opened = hits.select("id", F.inline(windows)).filter("marked").drop("marked")
    banded = opened.select("*", F.explode(signature("window")).alias("b")).select(
        "id", "length", "start", "window", "b.band", "b.low"
    )
    targets = wanted.select("*", F.explode(signature("own")).alias("b")).select(
        "license", "length", "own", "b.band", "b.low"
    )
    if BANDS * sum(len(r.shingles) for r in known) <= MOST_BROADCAST:
        targets = F.broadcast(targets)
    share = F.size(F.array_intersect("window", "own")) / F.size("own")
    return (
        banded.join(targets, ["length", "band", "low"])
        .filter(100 * F.size(F.array_intersect("window", "own")) >= SHARE * F.size("own"))
        .groupBy("id", "license", "start")
        .agg(F.max(share).alias("share"))
        .groupBy("id", "license")
        .agg(
            F.max("share").alias("containment"),
            F.count("*").alias("n_windows"),
            F.min("start").cast("long").alias("first_word"),
        )
        .withColumnRenamed("id", id_column)
    )


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    templates = spark.createDataFrame(TEMPLATES, "license string, body string")
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"), templates)


query = op5_licenses


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


ORACLE_SQL = f"""
WITH templates(license, body) AS (VALUES {", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in TEMPLATES)}),
sources AS (
    SELECT license AS name, NULL AS doc_id, regexp_extract_all(lower(body), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM templates
), own AS (
    SELECT DISTINCT name AS license, len(w) AS n, unnest(list_transform(range(1, len(w) - {WORDS - 2}),
        lambda i: array_to_string(w[i:i + {WORDS - 1}], ' '))) AS shingle FROM sources
), sizes AS (
    SELECT license, n, CAST(ceil(n / 4.0) AS BIGINT) AS step, count(*) AS total FROM own GROUP BY license, n
), body AS (
    SELECT doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), shingles AS (
    SELECT doc_id, unnest(range(len(w) - {WORDS - 1})) AS pos,
        unnest(list_transform(range(1, len(w) - {WORDS - 2}),
            lambda i: array_to_string(w[i:i + {WORDS - 1}], ' '))) AS shingle
    FROM body WHERE len(w) >= {WORDS}
), hits AS (
    SELECT s.doc_id, s.pos, s.shingle, o.license, z.n, z.step, z.total
    FROM shingles s JOIN own o USING (shingle) JOIN sizes z ON z.license = o.license
), windows AS (
    SELECT doc_id, license, total, shingle, unnest(range(pos - pos % step,
        greatest(-1, pos - (n + step - {WORDS - 1})), -step)) AS start FROM hits
), shares AS (
    SELECT doc_id, license, start, count(DISTINCT shingle) AS found, any_value(total) AS total
    FROM windows GROUP BY doc_id, license, start HAVING 100 * found >= {SHARE} * any_value(total)
)
SELECT doc_id, license, max(found / total) AS containment, count(DISTINCT start) AS n_windows,
    CAST(min(start) AS BIGINT) AS first_word
FROM shares GROUP BY doc_id, license
"""
