"""Bars from a stream: as operators.bars.rollup, with a watermark after which an interval is final."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_rollup(ticks: DataFrame, length: str = "5 minutes", late: str = "10 minutes", group: tuple[str, ...] = ("symbol",), ts: str = "ts", order: tuple[str, ...] = ("src_row",)) -> DataFrame:
    """Bars of a streaming table with open, high, low, close, volume; append mode emits final ones."""
    at = F.struct(F.col(ts), *map(F.col, order))
    kind = dict(ticks.dtypes)[ts]
    ticks = ticks.withColumn(ts, F.col(ts).cast("timestamp"))  # a watermark takes no other type
    return (
        ticks.withWatermark(ts, late).groupBy(*group, F.window(ts, length).alias("_interval")).agg(
            F.min_by("open", at).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", at).alias("close"), F.sum("volume").alias("volume"),
        )
        .select(*group, F.col("_interval.start").cast(kind).alias(ts), "open", "high", "low", "close", "volume")
    )
