"""Exact row-frame features over a symbol's rows, however many there are.

A window partitioned by symbol puts all rows of a symbol into one task. That is
the best plan while a symbol is small, and a lookback slice of one-minute
candles is (60 days are 86,400 rows). The rows of the largest symbol are counted
first; beyond ``Limits.symbol_rows`` the sequence is split:

1. Rows are range-partitioned and sorted by (symbol, time), numbered in that
   order, cut into chunks of equal size and written to the shared folder. Range
   bounds split a frequent symbol, and even copies of one candle.
2. Features are computed per (symbol, chunk). They are right except for the
   first rows of a chunk, whose frames reach into earlier chunks.
3. Those first rows are computed again from the chunk edges alone: the last rows
   of every chunk followed by the first rows of the next are contiguous. This is
   the same problem on a small fraction of the rows, so it is solved by the same
   function.
4. An EMA needs all earlier rows, but only through what they leave at the end of the
   chunk before. Chunks are summed up and composed in a tree, so no task holds all
   chunks of a symbol. See ``wickflow.operators.states``.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickflow.operators.ema import ChunkColumns, ema_layers, finished, gap_layers
from wickflow.operators.layers import Layers, add_layers
from wickflow.operators.states import exclusive_prefixes, summaries
from wickflow.session import scratch_path

# Ties on the close time are ordered by the close itself, the only other column
# the features read, so their values never depend on the order rows arrive in.
ORDER = ("candle_close_time", "close")


@dataclass(frozen=True)
class Limits:
    """``symbol_rows``: most rows of one symbol that a single task may hold.
    ``partition_rows``, ``chunk_rows``: sizes used when splitting; range partitions
    grow beyond theirs when there would be more than ``most_partitions``."""

    symbol_rows: int = 1_000_000
    partition_rows: int = 4_000_000
    chunk_rows: int = 131_072
    most_partitions: int = 20_000


class Sizes(NamedTuple):
    """Rows of the largest symbol, rows in all, largest ratio of two closes, and whether
    closes are missing (False if closes were not looked at)."""

    largest: int
    total: int
    spread: float
    missing: bool


def measure(candles: DataFrame, closes: bool = False) -> Sizes:
    """Sizes of the input, from one aggregate that combines on the map side.

    Only with ``closes`` is the close column read.
    """
    per_symbol = candles.groupBy("symbol").agg(
        F.count("*").alias("n"),
        *([F.min("close").alias("low"), F.max("close").alias("high"), F.count("close").alias("known")] if closes else []),
    )
    found = per_symbol.agg(
        F.max("n").alias("largest"),
        F.sum("n").alias("total"),
        *([F.min("low").alias("low"), F.max("high").alias("high"), F.sum("known").alias("known")] if closes else []),
    ).first()
    spread = math.inf
    if closes and found.low is not None and 0.0 < found.low <= found.high < math.inf:
        spread = found.high / found.low
    missing = closes and (found.known or 0) < (found.total or 0)
    return Sizes(found.largest or 0, found.total or 0, spread, missing)


def over_symbol_rows(
    candles: DataFrame,
    features: Iterable[Layers] = (),
    frame_rows: int = 0,
    spans: Iterable[int] = (),
    limits: Limits = Limits(),
) -> DataFrame:
    """Adds row-frame features and EMAs of ``close`` to the candles.

    The features depend on the current row and on at most ``frame_rows`` rows
    before it.
    """
    return _by_symbol(candles, list(features), frame_rows, tuple(spans), limits, ORDER, level=0)


def _by_symbol(candles, features, frame_rows, spans, limits, order, level) -> DataFrame:
    sizes = measure(candles, closes=bool(spans))
    if sizes.largest > limits.symbol_rows:
        return _by_chunk(candles, features, frame_rows, spans, limits, order, level, sizes)
    window = f"PARTITION BY symbol ORDER BY {', '.join(order)}"
    if sizes.missing:
        return finished(add_layers(candles, window, gap_layers(spans, sizes.largest), *features), spans)
    emas = ema_layers(spans, sizes.largest, sizes.spread, seeded=True)
    return add_layers(candles, window, emas, *features)


def _by_chunk(candles, features, frame_rows, spans, limits, order, level, sizes) -> DataFrame:
    # Each level has to leave fewer rows of a symbol for the next.
    if min(limits.symbol_rows, limits.partition_rows, limits.chunk_rows) < 8 * frame_rows:
        raise ValueError(f"limits are too small for frames of {frame_rows} rows")
    partitions = min(-(-sizes.total // limits.partition_rows), limits.most_partitions)
    names = ChunkColumns.at(level)
    by_chunk = f"PARTITION BY symbol, {names.chunk}"
    window = f"{by_chunk} ORDER BY {names.row}"
    chunks = _numbered_chunks(candles, order, names, partitions, limits.chunk_rows).withColumns(
        {
            names.place: F.expr(f"row_number() OVER ({window})"),
            names.size: F.expr(f"count(*) OVER ({by_chunk})"),
        }
    )
    emas = gap_layers(spans, limits.chunk_rows)

    def carried(rows: DataFrame) -> DataFrame:
        if spans:
            given = before.withColumnsRenamed({"symbol": "_of", names.chunk: "_chunk"})
            same = F.col("symbol").eqNullSafe(F.col("_of")) & (F.col(names.chunk) == F.col("_chunk"))
            rows = finished(rows.join(given, same).drop("_of", "_chunk"), spans, "before")
        return rows.drop(*names)

    if spans:
        runs = summaries(chunks, ["symbol", names.chunk], [names.row], spans, tail=0)
        most = partitions * (1 << 33) // limits.chunk_rows
        before = exclusive_prefixes(runs, names.chunk, most, spans, tail=0)
    inner = add_layers(chunks, window, emas, *features)
    if not features:
        return carried(inner)

    place, size = F.col(names.place), F.col(names.size)
    edges = chunks.filter((place <= frame_rows) | (place > size - frame_rows))
    heads = _by_symbol(edges, features, frame_rows, (), limits, [names.row], level + 1)
    heads = add_layers(heads.filter(place <= frame_rows), window, emas)
    return carried(inner.filter(place > frame_rows)).unionByName(carried(heads))


def _numbered_chunks(candles, order, names, partitions, chunk_rows) -> DataFrame:
    """Writes the rows in (symbol, order) sequence, numbered and cut into chunks."""
    key = ["symbol", *order, "_copy"]
    path = scratch_path(candles.sparkSession, "sequence")
    (
        candles.withColumn("_copy", F.monotonically_increasing_id())
        .repartitionByRange(partitions, *key)
        .sortWithinPartitions(*key)
        .drop("_copy")
        .withColumn(names.row, F.monotonically_increasing_id())
        .withColumn(names.chunk, F.expr(f"{names.row} div {chunk_rows}"))
        .write.parquet(path)
    )
    return candles.sparkSession.read.parquet(path)
