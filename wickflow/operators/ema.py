"""Exponential moving averages as a scan over ordered rows.

With ``alpha = 2 / (span + 1)`` and ``decay = 1 - alpha``::

    ema(1) = close(1)
    ema(t) = decay * ema(t - 1) + alpha * close(t)

Unrolled, an EMA is a sum of earlier terms weighted by powers of ``decay``. The
sum is built in rounds. After a round that covers ``reach`` rows, adding the
partial sums found 1, 2 and 3 times ``reach`` rows earlier covers ``4 * reach``
rows. All rounds are ``lag`` windows on one partitioning and one sort. Rounds
end when the reach covers the longest partition, or when all that is older could
not change the last bit of the sum: closes are positive, so the sum is at least
the smallest close, and older rows add at most ``decay ** reach`` times the
largest. Only positive powers occur, so nothing overflows.

Where closes are missing, weights differ from row to row (see ``states``), and rounds
carry the product of the rows' weights along (``gap_layers``). They give the map from the
EMA at the partition's first close to each row, so ``finished`` can start it there or from
what a state left. With none missing both ways give the same.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickflow.operators.layers import Layers, double, lag

RADIX = 4

# Well below the relative precision of a double, 2 ** -53.
LAST_BIT = 2.0**-60


class ChunkColumns(NamedTuple):
    """Columns that place a row in a split sequence: its number, its chunk, its
    1-based place in the chunk and the size of the chunk."""

    row: str
    chunk: str
    place: str
    size: str

    @classmethod
    def at(cls, level: int) -> ChunkColumns:
        return cls(*(f"_{name}{level}" for name in cls._fields))


def alpha(span: int) -> float:
    return 2.0 / (span + 1)


def decay(span: int) -> float:
    return 1.0 - alpha(span)


def column(span: int) -> str:
    return f"ema_{span}"


def ema_layers(
    spans: Iterable[int], most_rows: int, spread: float, seeded: bool
) -> Layers:
    """EMAs of ``close``: a layer of terms and one per round.

    Seeded ones start with the first close of each window partition; the others
    are the part of each EMA that comes from the partition itself. ``most_rows``
    is the size of the largest partition; ``spread`` bounds the ratio of two
    closes, and is infinite when a close is not positive.
    """
    spans = tuple(spans)
    layers = [{column(s): _term(s, seeded) for s in spans}] if spans else []
    negligible = LAST_BIT / spread
    reach = 1
    while reach < most_rows:
        open_spans = [s for s in spans if decay(s) ** reach > negligible]
        if not open_spans:
            break
        layers.append({column(s): _round(s, reach) for s in open_spans})
        reach *= RADIX
    return layers


def _term(span: int, seeded: bool) -> str:
    term = f"{double(alpha(span))} * close"
    if not seeded:
        return term
    return f"CASE WHEN row_number() OVER ({{w}}) = 1 THEN close ELSE {term} END"


def _round(span: int, reach: int) -> str:
    weights = {back: decay(span) ** back for back in range(reach, RADIX * reach, reach)}
    earlier = [
        f"{double(weight)} * {lag(column(span), back, '0D')}"
        for back, weight in weights.items()
        if weight > 0.0
    ]
    return " + ".join([column(span), *earlier])


def gap_layers(spans: Iterable[int], most_rows: int) -> Layers:
    """Maps of EMAs where closes may be missing: ``held`` and ``ema`` of each span, and the
    place and value of the partition's first close, for ``finished``."""
    spans = tuple(spans)
    if not spans:
        return []
    so_far = "OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    layers: Layers = [
        {"_seen": "CASE WHEN close IS NOT NULL THEN row_number() OVER ({w}) END"},
        {
            "_before": "max(_seen) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)",
            "first_place": f"min(_seen) {so_far}",
            "first_close": f"first_value(close) IGNORE NULLS {so_far}",
        },
    ]
    start: dict[str, str] = {}
    for s in spans:
        old = f"power({double(decay(s))}, _seen - _before)"
        new = double(alpha(s))
        start[f"held_{s}"] = (
            f"CASE WHEN _before IS NULL OR _seen IS NULL THEN 1D WHEN _seen - _before = 1 THEN {double(decay(s))}"
            f" ELSE {old} / ({old} + {new}) END"
        )
        start[column(s)] = (
            f"CASE WHEN _before IS NULL OR _seen IS NULL THEN 0D WHEN _seen - _before = 1 THEN {new} * close"
            f" ELSE {new} / ({old} + {new}) * close END"
        )
    layers.append(start)
    reach = 1
    while reach < most_rows:
        lags: dict[str, str] = {}
        rounds: dict[str, str] = {}
        for s in spans:
            held, added = [f"held_{s}"], []
            for k in range(1, RADIX):
                lags[f"_held_{s}_{k}"] = lag(f"held_{s}", k * reach, "1D")
                lags[f"_ema_{s}_{k}"] = lag(column(s), k * reach, "0D")
                added.append(f"{' * '.join(held)} * _ema_{s}_{k}")
                held.append(f"_held_{s}_{k}")
            rounds[column(s)] = " + ".join([column(s), *added])
            rounds[f"held_{s}"] = " * ".join(held)
        layers += [lags, rounds]
        reach *= RADIX
    return layers


def finished(rows: DataFrame, spans: Iterable[int], before: str | None = None) -> DataFrame:
    """Rows of ``gap_layers`` with their EMAs, after what the state in column ``before``
    tells of the rows that precede, if there is one."""
    spans = tuple(spans)
    if not spans:
        return rows if before is None else rows.drop(before)
    values = {}
    for s in spans:
        own = f"held_{s} * first_close + {column(s)}"
        if before is None:
            values[column(s)] = F.expr(own)
            continue
        old = f"{before}.held_{s} * {before}.first_close + {before}.added_{s}"
        kept = f"power({double(decay(s))}, {before}.trail + first_place)"
        w = f"({kept} / ({kept} + {double(alpha(s))}))"
        values[column(s)] = F.expr(
            f"CASE WHEN {before}.first IS NULL THEN {own} WHEN first_place IS NULL THEN {old}"
            f" ELSE held_{s} * ({w} * ({old}) + (1 - {w}) * first_close) + {column(s)} END"
        )
    gone = [*(f"held_{s}" for s in spans), "first_place", "first_close", *([before] if before else [])]
    return rows.withColumns(values).drop(*gone)


def apply_carries(rows: DataFrame, spans: Iterable[int], place: str) -> DataFrame:
    """Adds what the ``carry`` columns leave after ``place`` rows."""
    return rows.withColumns(
        {
            column(s): F.col(column(s))
            + F.pow(F.lit(decay(s)), F.col(place)) * F.col(f"carry_{s}")
            for s in spans
        }
    ).drop(*(f"carry_{s}" for s in spans))


def carried_over(spans: Iterable[int]) -> dict[str, str]:
    """SQL of the EMAs that a symbol's rows with ``_today`` false end in.

    Needs ``_place`` and ``_size`` within (symbol, _today) and ``_seed``, the
    symbol's first close, which is also the result when there are no such rows.
    """
    of_symbol = "OVER (PARTITION BY symbol)"
    return {
        f"carry_{s}": f"coalesce(sum(CASE WHEN NOT _today THEN {double(alpha(s))} * close"
        f" * power({double(decay(s))}, _size - _place) END) {of_symbol}, 0D)"
        f" + power({double(decay(s))}, count_if(NOT _today) {of_symbol}) * _seed"
        for s in spans
    }
