"""Swing points and market structure, as window expressions over each series.

All functions take bars with the series columns, an order column and prices, and add columns. They share
one partitioning by series, so a chain of them shuffles once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import PivotConfig


def _series(group: tuple[str, ...], order: str):
    return W.partitionBy(*group).orderBy(order)


def pivots(bars: DataFrame, config: PivotConfig = PivotConfig(), group: tuple[str, ...] = ("symbol",), order: str = "ts") -> DataFrame:
    """pivot_kind "high" or "low" and pivot_price of bars that stand out on both sides, else null.

    A high is above all highs on its left, and above (strict_right) or not below those on its right; a low
    likewise. All neighbours must exist, and a bar that is both counts as a high.
    """
    own = _series(group, order)
    left, right = own.rowsBetween(-config.left, -1), own.rowsBetween(1, config.right)
    whole = (F.count("*").over(left) == config.left) & (F.count("*").over(right) == config.right)
    above, below = F.max("high").over(right), F.min("low").over(right)
    high = (F.col("high") > F.max("high").over(left)) & (F.col("high") > above if config.strict_right else F.col("high") >= above)
    low = (F.col("low") < F.min("low").over(left)) & (F.col("low") < below if config.strict_right else F.col("low") <= below)
    kind = F.when(whole & high, "high").when(whole & low, "low")
    return bars.withColumn("pivot_kind", kind).withColumn("pivot_price", F.when(F.col("pivot_kind") == "high", F.col("high")).when(F.col("pivot_kind") == "low", F.col("low")))


def zigzag(pivoted: DataFrame, group: tuple[str, ...] = ("symbol",), order: str = "ts") -> DataFrame:
    """Of neighbouring pivots of a kind the most extreme stays, of equal ones the earliest; the rest become null."""
    own = _series(group, order)
    before = F.last("pivot_kind", ignorenulls=True).over(own.rowsBetween(W.unboundedPreceding, -1))
    turn = F.col("pivot_kind").isNotNull() & ~F.col("pivot_kind").eqNullSafe(before)
    signed = F.when(F.col("pivot_kind") == "high", -F.col("pivot_price")).when(F.col("pivot_kind") == "low", F.col("pivot_price"))
    leg = F.sum(F.col("_turn").cast("int")).over(own)
    rank = F.row_number().over(W.partitionBy(*group, "_leg").orderBy(F.col("_signed").asc_nulls_last(), order))
    kept = pivoted.withColumn("_turn", turn).withColumns({"_leg": leg, "_signed": signed}).withColumn("_rank", rank)
    stays = F.col("pivot_kind").isNotNull() & (F.col("_rank") == 1)
    return kept.withColumns({c: F.when(stays, F.col(c)) for c in ("pivot_kind", "pivot_price")}).drop("_turn", "_leg", "_signed", "_rank")


def _previous(pivoted: DataFrame, group: tuple[str, ...], order: str) -> DataFrame:
    """_before: the price of the kept pivot of the same kind before."""
    return pivoted.withColumn("_before", F.when(F.col("pivot_kind").isNotNull(), F.lag("pivot_price").over(W.partitionBy(*group, "pivot_kind").orderBy(order))))


def swing_flags(pivoted: DataFrame, group: tuple[str, ...] = ("symbol",), order: str = "ts") -> DataFrame:
    """Higher_Low, Higher_High, Lower_Low, Lower_High: 1 where a pivot differs so from the one of its kind before."""
    if clash := {c.lower() for c in pivoted.columns} & {"higher_low", "higher_high", "lower_low", "lower_high"}:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    rows = _previous(pivoted, group, order)
    flag = lambda kind, up: F.coalesce((F.col("pivot_kind") == kind) & (F.col("pivot_price") > F.col("_before") if up else F.col("pivot_price") < F.col("_before")), F.lit(False)).cast("int")
    return rows.withColumns({"Higher_Low": flag("low", True), "Higher_High": flag("high", True), "Lower_Low": flag("low", False), "Lower_High": flag("high", False)}).drop("_before")


def structure_labels(pivoted: DataFrame, config: PivotConfig = PivotConfig(), group: tuple[str, ...] = ("symbol",), order: str = "ts") -> DataFrame:
    """pivot_label HH, LH, HL or LL (the first of a kind counts as higher, an equal one as lower), and
    confirmed_at, the number of the bar that completes the pivot's right side; bars count from 0."""
    rows = _previous(pivoted, group, order)
    higher = F.col("_before").isNull() | (F.col("pivot_price") > F.col("_before"))
    label = F.when(F.col("pivot_kind") == "high", F.when(higher, "HH").otherwise("LH")).when(F.col("pivot_kind") == "low", F.when(higher, "HL").otherwise("LL"))
    at = F.row_number().over(_series(group, order)) - 1
    return rows.withColumns({"pivot_label": label, "bar": at}).withColumn("confirmed_at", F.when(F.col("pivot_kind").isNotNull(), F.col("bar") + config.right)).drop("_before")


def levels(pivoted: DataFrame, config: PivotConfig = PivotConfig(), group: tuple[str, ...] = ("symbol",), order: str = "ts") -> DataFrame:
    """support and resistance of each bar: the latest low and high that are confirmed by then."""
    own = _series(group, order)
    known = lambda kind: F.last(F.col(f"_{kind}"), ignorenulls=True).over(own)
    late = {f"_{k}": F.lag(F.when(F.col("pivot_kind") == k, F.col("pivot_price")), config.right).over(own) for k in ("low", "high")}
    return pivoted.withColumns(late).withColumns({"support": known("low"), "resistance": known("high")}).drop("_low", "_high")


def trend(levelled: DataFrame, group: tuple[str, ...] = ("symbol",), order: str = "ts") -> DataFrame:
    """trend of each bar (1 up, -1 down, 0 none yet), event (the new trend where it changes) and event_level.

    A close above resistance turns the trend up, else one below support turns it down; a bar that is on
    either side so turns whatever trend there is. So the trend is the last one-sided break's, turned once
    for each two-sided bar since; before any one-sided break the first two-sided bar turns it up.
    """
    own = _series(group, order)
    up = F.coalesce(F.col("close") > F.col("resistance"), F.lit(False))
    down = F.coalesce(F.col("close") < F.col("support"), F.lit(False))
    rows = levelled.withColumns({"_set": F.when(up & ~down, 1).when(down & ~up, -1), "_both": (up & down).cast("int")})
    rows = rows.withColumns({"_anchor": F.last("_set", ignorenulls=True).over(own), "_stretch": F.count("_set").over(own)})
    rows = rows.withColumn("_turns", F.sum("_both").over(W.partitionBy(*group, "_stretch").orderBy(order)))
    odd = F.col("_turns") % 2 == 1
    state = F.when(F.col("_anchor").isNotNull(), F.when(odd, -F.col("_anchor")).otherwise(F.col("_anchor"))).when(F.col("_turns") == 0, 0).when(odd, 1).otherwise(-1)
    rows = rows.withColumn("trend", state).withColumn("event", F.when(F.col("trend") != F.coalesce(F.lag("trend").over(own), F.lit(0)), F.col("trend")))
    return rows.withColumn("event_level", F.when(F.col("event") == 1, F.col("resistance")).when(F.col("event") == -1, F.col("support"))).drop("_set", "_both", "_anchor", "_stretch", "_turns")


def trend_now(trended: DataFrame, group: tuple[str, ...] = ("symbol",), order: str = "ts") -> DataFrame:
    """The last bar's support, resistance and trend by series; without a break the last four pivots decide."""
    recent = F.row_number().over(W.partitionBy(*group).orderBy(F.col("pivot_label").isNull(), F.desc(order))) <= 4
    labels = trended.select(*group, order, "trend", "support", "resistance", "pivot_label", recent.alias("_recent"))
    last = F.struct(order, "trend", "support", "resistance")
    label = F.when(F.col("_recent"), F.col("pivot_label"))
    out = labels.groupBy(*group).agg(F.max(last).alias("_last"), F.count("pivot_label").alias("n_pivots"), F.max(F.coalesce(label.isin("HH", "HL"), F.lit(False))).alias("_up"), F.max(F.coalesce(label.isin("LH", "LL"), F.lit(False))).alias("_down"))
    guess = F.when(F.col("n_pivots") < 2, 0).when(F.col("_up"), 1).when(F.col("_down"), -1).otherwise(0)
    return out.select(*group, F.when(F.col("_last.trend") != 0, F.col("_last.trend")).otherwise(guess).alias("trend"), F.col("_last.support").alias("support"), F.col("_last.resistance").alias("resistance"), "n_pivots")
