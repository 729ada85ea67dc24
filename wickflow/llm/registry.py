"""The registered queries: ``opN_<name>`` applies operator N to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wickflow.llm import (
    decontaminate,
    divergence,
    licenses,
    pieces,
    ppm,
    quality,
    repeats,
    simhash,
    tokenfile,
    toxicity,
    urlrules,
    variants,
    warc,
)

MODULES = [licenses, ppm, toxicity, quality, urlrules, decontaminate, pieces, simhash, tokenfile, warc, variants, repeats, divergence]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {module.query.__name__: module.query for module in MODULES}


def oracle_sql() -> dict[str, str]:
    return {m.query.__name__: m.ORACLE_SQL for m in MODULES if m.ORACLE_SQL is not None}
