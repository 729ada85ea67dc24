"""What a run of a symbol's rows does to its EMAs and frames, as a value that composes.

A missing close (NULL; a NaN counts as one) keeps its row. It carries the EMA on, and the
next close weighs more: after ``gap`` rows the old value has ``decay ** gap`` parts
against ``alpha`` of the new one, so with no row missing it has ``decay``.

A run of rows is summed up by its ``n`` rows; the place ``first`` and value ``first_close``
of its first close; the rows ``trail`` after its last one; for each span the map
``held * ema + added`` from the EMA at the first close to that at the end; and its last
closes, newest first, as far as frames look back. Two runs that follow each other compose
to the same kind of value. So runs are summed up anywhere, kept, and put together in a
tree: ``exclusive_prefixes`` says what lies before each run, and no task sees more than
``FAN`` of them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickflow.operators.ema import alpha, column, decay

FAN = 256


def known_close() -> Column:
    """``close``, NULL where it is NaN."""
    return F.when(~F.isnan("close"), F.col("close"))


def weight(gap: Column, span: int) -> Column:
    """Share of the old EMA when a close follows it ``gap`` rows later."""
    old = F.pow(F.lit(decay(span)), gap)
    return F.when(gap == 1, F.lit(decay(span))).otherwise(old / (old + alpha(span)))


def summaries(rows: DataFrame, keys: list[str], order: Iterable[str], spans: Iterable[int], tail: int) -> DataFrame:
    """``keys``, ``state``, and the times of the first and last candle of each run of rows."""
    spans = tuple(spans)
    window = f"PARTITION BY {', '.join(keys)} ORDER BY {', '.join(order)}"
    placed = rows.select(*keys, "candle_close_time", "close", *(c for c in order if c not in {"candle_close_time", "close"}))
    placed = placed.withColumns(
        {"_place": F.expr(f"row_number() OVER ({window})"), "_n": F.expr(f"count(*) OVER (PARTITION BY {', '.join(keys)})")}
    )
    placed = placed.withColumn("_seen", F.when(F.col("close").isNotNull(), F.col("_place")))
    before = f"max(_seen) OVER ({window} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    placed = placed.withColumn("_gap", F.col("_seen") - F.expr(before))
    # steps after a row: plain ones by their number, those over a gap by their logarithm
    odd = {f"_odd_{s}": F.when(F.col("_gap") > 1, F.ln(weight(F.col("_gap"), s))).otherwise(0.0) for s in spans}
    placed = placed.withColumns({"_plain": F.coalesce((F.col("_gap") == 1).cast("int"), F.lit(0))} | odd)
    totals = {
        f"{name}_after": F.expr(
            f"sum({name}) OVER (PARTITION BY {', '.join(keys)}) - sum({name}) OVER ({window} ROWS UNBOUNDED PRECEDING)"
        )
        for name in ("_plain", *odd)
    }
    placed = placed.withColumns(totals)

    def maps(s: int) -> list[Column]:
        after = F.pow(F.lit(decay(s)), F.col("_plain_after")) * F.exp(f"_odd_{s}_after")
        new = F.when(F.col("_gap") == 1, F.lit(alpha(s))).otherwise(1 - weight(F.col("_gap"), s))
        held = F.max(F.when(F.col("_seen").isNotNull() & F.col("_gap").isNull(), after))
        added = F.sum(F.when(F.col("_gap").isNotNull(), new * F.col("close") * after))
        return [F.coalesce(held, F.lit(1.0)).alias(f"held_{s}"), F.coalesce(added, F.lit(0.0)).alias(f"added_{s}")]

    last = F.when(F.col("_place") > F.col("_n") - tail, F.struct((-F.col("_place")).alias("place"), "close"))
    closes = F.transform(F.array_sort(F.collect_list(last)), lambda x: x["close"])
    found = placed.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.min("_seen").cast("long").alias("first"),
        F.min_by("close", "_seen").alias("first_close"),
        (F.count("*") - F.coalesce(F.max("_seen"), F.lit(0))).alias("trail"),
        *(c for s in spans for c in maps(s)),
        closes.alias("closes"),
        F.min("candle_close_time").alias("first_at"),
        F.max("candle_close_time").alias("last_at"),
    )
    return found.select(*keys, F.struct(*_fields(spans)).alias("state"), "first_at", "last_at")


def _fields(spans: Iterable[int]) -> list[str]:
    maps = [f"{kind}_{s}" for s in spans for kind in ("held", "added")]
    return ["n", "first", "first_close", "trail", *maps, "closes"]


def nothing(spans: Iterable[int]) -> Column:
    """The state of a run without rows."""
    maps = [F.lit(v).alias(f"{kind}_{s}") for s in spans for kind, v in (("held", 1.0), ("added", 0.0))]
    return F.struct(
        F.lit(0).cast("long").alias("n"),
        F.lit(None).cast("long").alias("first"),
        F.lit(None).cast("double").alias("first_close"),
        F.lit(0).cast("long").alias("trail"),
        *maps,
        F.expr("CAST(array() AS array<double>)").alias("closes"),
    )


def compose(a: Column, b: Column, spans: Iterable[int], tail: int) -> Column:
    """The state of the rows of ``a`` followed by those of ``b``."""
    no_a, no_b = a["first"].isNull(), b["first"].isNull()
    maps = []
    for s in spans:
        w = weight(a["trail"] + b["first"], s)
        held, added = f"held_{s}", f"added_{s}"
        both = b[held] * (w * a[added] + (1 - w) * b["first_close"]) + b[added]
        maps.append(F.when(no_a, b[held]).when(no_b, a[held]).otherwise(b[held] * w * a[held]).alias(held))
        maps.append(F.when(no_a, b[added]).when(no_b, a[added]).otherwise(both).alias(added))
    return F.struct(
        (a["n"] + b["n"]).alias("n"),
        F.coalesce(a["first"], a["n"] + b["first"]).alias("first"),
        F.when(no_a, b["first_close"]).otherwise(a["first_close"]).alias("first_close"),
        F.when(no_b, a["trail"] + b["n"]).otherwise(b["trail"]).alias("trail"),
        *maps,
        F.slice(F.concat(b["closes"], a["closes"]), 1, max(1, tail)).alias("closes"),
    )


def folded(children: Column, spans: Iterable[int], tail: int) -> Column:
    """The state of an array of runs in order, each a struct with ``state``."""
    return F.aggregate(children, nothing(spans), lambda done, run: compose(done, run["state"], spans, tail))


def ended(state: Column, span: int) -> Column:
    """The EMA after rows that nothing precedes; NULL without a close."""
    return state[f"held_{span}"] * state["first_close"] + state[f"added_{span}"]


def exclusive_prefixes(runs: DataFrame, number: str, most: int, spans: Iterable[int], tail: int) -> DataFrame:
    """symbol, ``number`` and ``before``: the state of the symbol's rows in runs of smaller
    numbers. ``runs`` has symbol, ``number`` (0 to ``most``) and state, a row per run.

    Runs are composed ``FAN`` at a time up a tree, and prefixes handed down it.
    """
    spans = tuple(spans)

    def of_parent(level: DataFrame) -> DataFrame:
        own = F.struct(F.col("no"), F.col("state"))
        parent = F.floor(F.col("no") / FAN).cast("long").alias("no")
        return level.groupBy("symbol", parent).agg(F.array_sort(F.collect_list(own), _by_number).alias("children"))

    levels = [of_parent(runs.select("symbol", F.col(number).cast("long").alias("no"), "state"))]
    reach = FAN
    while reach <= most:
        above = levels[-1].select("symbol", "no", folded(F.col("children"), spans, tail).alias("state"))
        levels.append(of_parent(above))
        reach *= FAN
    before = levels[-1].withColumn("before", nothing(spans))
    for depth in range(len(levels) - 1, -1, -1):
        below = _handed_down(before, spans, tail)
        if depth == 0:
            return below.withColumnRenamed("no", number)
        given = below.withColumnsRenamed({"symbol": "_symbol", "no": "_no"})
        same = F.col("symbol").eqNullSafe(F.col("_symbol")) & (F.col("no") == F.col("_no"))
        before = levels[depth - 1].join(given, same).drop("_symbol", "_no")
    raise AssertionError("a tree has a lowest level")


def _by_number(a: Column, b: Column) -> Column:
    return F.when(a["no"] < b["no"], F.lit(-1)).otherwise(F.lit(1))


def _handed_down(parents: DataFrame, spans: tuple[int, ...], tail: int) -> DataFrame:
    """What lies before each child of parents with ``children`` and ``before``."""
    kind = parents.schema["before"].dataType.simpleString()
    none = F.expr(f"CAST(array() AS array<struct<no: bigint, before: {kind}>>)")
    found = F.aggregate(
        "children",
        F.struct(F.col("before").alias("done"), none.alias("out")),
        lambda so_far, run: F.struct(
            compose(so_far["done"], run["state"], spans, tail).alias("done"),
            F.array_append(so_far["out"], F.struct(run["no"].alias("no"), so_far["done"].alias("before"))).alias("out"),
        ),
        lambda so_far: so_far["out"],
    )
    return parents.select("symbol", F.explode(found).alias("child")).select("symbol", "child.no", "child.before")
