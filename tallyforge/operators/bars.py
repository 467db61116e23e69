"""Rolling bars up, and choosing among them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_BAR = ("open", "high", "low", "close", "volume")


def rollup(df: DataFrame, length: str = "5 minutes", group: tuple[str, ...] = ("symbol",), ts: str = "ts", order: tuple[str, ...] = ("src_row",)) -> DataFrame:
    """Bars of ``length``: first open, highest high, lowest low, last close, total volume, other columns of
    the first row; ``ts`` is the start of the interval. Only intervals with rows are made.

    Aggregates combine before the shuffle, and the interval is part of the key, so a busy series spreads.
    """
    at = F.struct(F.col(ts), *map(F.col, order))
    others = [c for c in df.columns if c not in (*_BAR, *group, ts)]
    return (
        df.groupBy(*group, F.window(ts, length).alias("_interval")).agg(
            F.min_by("open", at).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", at).alias("close"),
            F.sum("volume").alias("volume"), *(F.min_by(c, at).alias(c) for c in others),
        )
        .select(*group, F.col("_interval.start").alias(ts), *_BAR, *others)
    )


def valid_bars(df: DataFrame) -> DataFrame:
    """Rows whose prices are numbers in a sound envelope, with double prices; the others are passed over."""
    prices = {c: F.col(c).cast("string").try_cast("double") for c in _BAR[:4]}
    sound = (F.col("low") <= F.least("open", "close")) & (F.greatest("open", "close") <= F.col("high"))
    finite = [F.col(c).isNotNull() & ~F.isnan(c) for c in _BAR[:4]]  # least and greatest pass over nulls
    return df.withColumns(prices).where(F.coalesce(sound & reduce(lambda a, b: a & b, finite), F.lit(False)))


def dedup_last(df: DataFrame, group: tuple[str, ...] = ("symbol",), ts: str = "ts", order: str = "src_row") -> DataFrame:
    """Of rows with the same series and time the last one."""
    rank = F.row_number().over(W.partitionBy(*group, ts).orderBy(F.desc(order)))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def latest_series(df: DataFrame, group: tuple[str, ...] = ("symbol",), ts: str = "ts", order: str = "src_row", symbol: str | None = None) -> DataFrame:
    """One row: the series with the latest time, of equal ones the one that has it first."""
    rows = df if symbol is None else df.where(F.col("symbol") == symbol)
    return rows.agg(F.max_by(F.struct(*group), F.struct(F.col(ts), -F.col(order))).alias("g")).where("g is not null").select("g.*")


def of_series(df: DataFrame, series: DataFrame, group: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """df's rows of the one series of latest_series(), a single row."""
    renamed = series.select(*(F.col(c).alias(f"_{c}") for c in group))
    same: Column = F.lit(True)
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return df.join(F.broadcast(renamed), same, "left_semi")


def between(df: DataFrame, first: str | None = None, last: str | None = None, ts: str = "ts") -> DataFrame:
    """Rows from first to last, both included."""
    if first is not None:
        df = df.where(F.col(ts) >= F.lit(first).cast("timestamp_ntz"))
    return df if last is None else df.where(F.col(ts) <= F.lit(last).cast("timestamp_ntz"))


def read_series(df: DataFrame, group: tuple[str, ...] = ("symbol",), ts: str = "ts", order: str = "src_row", symbol: str | None = None, first: str | None = None, last: str | None = None, tail: int | None = None) -> DataFrame:
    """What the filter is to be given of a table of bars (see sources.tables.resolve() for its names): one series, sound and in range.

    The series with the latest time, or with that symbol; of it the rows with a time whose prices are numbers in a
    sound envelope; of equal times the last; from ``first`` to ``last``; of these the last ``tail``. A missing or
    null volume is 1, a negative one 0. A table without such a series has no rows.
    """
    if tail is not None and tail < 2:
        raise ValueError("a tail has 2 rows or more")
    if symbol is not None and "symbol" not in df.columns:
        raise ValueError("there is no column symbol to choose by")
    timed = df.where(F.col(ts).isNotNull())
    own = valid_bars(of_series(timed, latest_series(timed, group, ts, order, symbol), group)) if group else valid_bars(timed)
    volume = F.col("volume").cast("string").try_cast("double") if "volume" in df.columns else F.lit(None).cast("double")
    volume = F.when(~F.isnan(volume), volume)
    own = own.withColumn("volume", F.greatest(F.coalesce(volume, F.lit(1.0)), F.lit(0.0)))
    ranged = between(dedup_last(own, group, ts, order), first, last, ts)
    return ranged if tail is None else ranged.orderBy(F.desc(ts)).limit(tail)
