"""The filter of operators.kalman on a stream of bars: each series' state lives in the state store.

Bars may come in any order within the watermark. Those that it hasn't passed wait in the state of their
series; when it does, they are taken in order of time, so the result is that of the batch query. A bar at or
before the watermark is late: Spark drops it before it gets here and counts it in the query's progress
(numRowsDroppedByWatermark). A query that is started again with its checkpoint goes on from the stored
state. State is a series' filter (some 150 numbers) and its bars of the watermark's delay.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.kalman import COLUMNS, Options, Tracker

_PRICES = ("open", "high", "low", "close", "volume")


class _Series(StatefulProcessor):
    """One series' bars with time_micros, their time in microseconds; COLUMNS of those that the watermark has passed."""

    def __init__(self, schema: T.StructType, options: Options):
        self.schema, self.options = schema, options
        self.at = schema.names.index("time_micros")
        self.prices = [schema.names.index(c) for c in _PRICES]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.filter = handle.getValueState("filter", T.StructType([T.StructField("numbers", T.ArrayType(T.DoubleType()))]))
        self.waiting = handle.getListState("waiting", self.schema)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        first = None
        for part in rows:
            if part.empty:
                continue
            # by place: names that aren't plain Python names come changed
            columns = (part.iloc[:, i].astype(object) for i in range(len(self.schema.names)))
            values = [tuple(None if v is None or v != v else v for v in row) for row in zip(*columns, strict=True)]
            self.waiting.appendList(values)
            earliest = min(v[self.at] for v in values)
            first = earliest if first is None else min(first, earliest)
        if first is not None:
            self._wake(first)
        return iter(())

    def _wake(self, micros: int) -> None:
        """Asks for a call when the watermark has passed that time."""
        self.handle.registerTimer(int(micros) // 1000 - 1)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        rows = sorted((tuple(r) for r in self.waiting.get()), key=lambda r: r[self.at]) if self.waiting.exists() else []
        due = [r for r in rows if r[self.at] <= passed]
        if len(due) < len(rows):
            self._wake(rows[len(due)][self.at])
        if not due:
            return
        tracker = Tracker.of(list(self.filter.get()[0]), self.options) if self.filter.exists() else Tracker(self.options)
        found = [tracker.step(*(None if r[i] is None else float(r[i]) for i in self.prices)) for r in due]
        self.filter.update((tracker.numbers(),))
        if len(due) < len(rows):
            self.waiting.put(rows[len(due) :])
        else:
            self.waiting.clear()
        yield pd.DataFrame([(*r, *map(float, f)) for r, f in zip(due, found, strict=True)], columns=[*self.schema.names, *COLUMNS])

    def close(self) -> None:
        pass


def stream_filter(bars: DataFrame, late: str = "10 minutes", group: tuple[str, ...] = ("symbol",), order: str = "ts", options: Options = Options()) -> DataFrame:
    """A streaming table of bars with COLUMNS, in append mode; ``late``: how long a bar may come after a later one.

    Prices and volume become doubles. Bars without a time are dropped, as the watermark can't pass them.
    """
    if clash := {c.lower() for c in bars.columns} & {*COLUMNS, "time_micros", "time_passed"}:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    kind, names = dict(bars.dtypes)[order], bars.columns
    timed = bars.withColumn("time_passed", F.col(order).cast("timestamp")).where("time_passed is not null").withWatermark("time_passed", late)
    carried = [F.col(c).cast("double").alias(c) if c in _PRICES else F.col(f"`{c}`") for c in names if c != order]
    timed = timed.select(*carried, F.unix_micros("time_passed").alias("time_micros"), "time_passed")
    schema = T.StructType(timed.schema.fields[:-1])
    out = T.StructType([*schema.fields, *(T.StructField(c, T.DoubleType()) for c in COLUMNS)])
    found = timed.groupBy(*group).transformWithStateInPandas(_Series(schema, options), out, "append", "eventTime")
    return found.withColumn(order, F.timestamp_micros("time_micros").cast(kind)).select(*names, *COLUMNS)
