"""Column helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """The column, computed once per row.

    A filter on a projected column is moved below the projection, with the column's
    expression in its place; inside a lambda that expression would then run for every
    element. Behind a generator of one row it stays where it is.
    """
    return df.withColumn(name, F.explode(F.array(column)))


def apart(docs: DataFrame, text: str, columns: list[str] | None = None) -> tuple[DataFrame, Column]:
    """``rest`` and ``text`` of the rows, so that a Python worker is sent the text once, and
    the struct of ``columns`` (default: all) put together again from the two."""
    columns = docs.columns if columns is None else columns
    others = [c for c in columns if c != text]
    named = [F.col("`" + c.replace("`", "``") + "`").alias(f"c{i}") for i, c in enumerate(others)]
    at = {c: f"rest.c{i}" for i, c in enumerate(others)} | {text: "text"}
    packed = docs.select(F.struct(F.lit(0).alias("none"), *named).alias("rest"), F.col(text).alias("text"))
    return packed, F.struct(*(F.col(at[c]).alias(c) for c in columns))
