"""Candles held back until a symbol has enough of them, or long enough.

Held candles are keyed state: they survive a restart with the stream's checkpoint, and a
symbol's go on together. At most ``events`` of a symbol are held, and no more are gathered
in memory before they are handed on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from wickflow.schemas import RAW_CANDLES, RAW_COLUMNS

# Candles of a symbol, and seconds, after which they are flushed.
FLUSH_EVENTS, FLUSH_SECONDS = 100, 300

# The candles as an Arrow stream, their number, and when they are due (epoch ms).
STATE = "held binary, n bigint, due bigint"


def _packed(rows: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.Table.from_pandas(rows, preserve_index=False)
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_all().to_pandas()


def _held(events: int, seconds: int) -> Callable[..., Iterator[pd.DataFrame]]:
    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, n, due = state.get if state.exists else (None, 0, 0)
        now = state.getCurrentProcessingTimeMs()
        if state.hasTimedOut:
            state.remove()
            yield _unpacked(held)
            return
        waiting = [_unpacked(held)] if held else []
        for frame in frames:
            n += len(frame)
            waiting.append(frame[RAW_COLUMNS])
            if n >= events:  # whatever else this batch brings goes on with them
                yield from waiting
                waiting = []
        if not waiting:
            if state.exists:
                state.remove()
            return
        due = due or now + 1_000 * seconds
        state.update((_packed(pd.concat(waiting, ignore_index=True)), n, due))
        state.setTimeoutDuration(max(1, due - now))

    return step


def buffered(candles: DataFrame, events: int = FLUSH_EVENTS, seconds: int = FLUSH_SECONDS) -> DataFrame:
    """A stream of candles, each symbol's held back until it has ``events`` of them, or for
    ``seconds`` after the first of them came."""
    return candles.groupBy("symbol").applyInPandasWithState(
        _held(events, seconds), RAW_CANDLES, STATE, "append", GroupStateTimeout.ProcessingTimeTimeout
    )
