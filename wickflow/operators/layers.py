"""Window features as layers of SQL columns.

A layer reads the input and the layers before it. All window expressions of a layer
share one pass over the sorted rows, and layers of several features go side by side,
so the number of passes is that of the deepest feature. ``{w}`` stands for the window;
names that start with an underscore are intermediate.
"""

from __future__ import annotations

from itertools import zip_longest

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Layers = list[dict[str, str]]


def trailing(aggregate: str, rows: int) -> str:
    """An aggregate over the ``rows`` rows before the current one."""
    return f"{aggregate} OVER ({{w}} ROWS BETWEEN {rows} PRECEDING AND 1 PRECEDING)"


def lag(name: str, back: int, empty: str = "NULL") -> str:
    return f"lag({name}, {back}, {empty}) OVER ({{w}})"


def double(value: float) -> str:
    """A double as a SQL literal."""
    return f"{value!r}D"


def add_layers(rows: DataFrame, window: str, *features: Layers) -> DataFrame:
    """Adds the columns of the features, without their intermediate ones."""
    names = dict.fromkeys(rows.columns)
    for layer in zip_longest(*features, fillvalue={}):
        columns = {name: sql for part in layer for name, sql in part.items()}
        rows = rows.withColumns({n: F.expr(sql.format(w=window)) for n, sql in columns.items()})
        names.update(dict.fromkeys(name for name in columns if not name.startswith("_")))
    return rows.select(*names)
