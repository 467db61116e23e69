"""Bar indicators: window expressions, and linear recursions as scans of affine maps over pieces of a series."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def features(bars: DataFrame, group: tuple[str, ...] = ("symbol",), order: str = "ts") -> DataFrame:
    """midpoint, ohlc4, velocities (midpoint, ohlc4, close location, blend), true range, volume mean and mass."""
    own = W.partitionBy(*group).orderBy(order)
    before = lambda c: F.coalesce(F.lag(c).over(own), F.col(c))
    d = {c: F.col(c).cast("double") for c in ("open", "high", "low", "close")}
    rows = bars.withColumns({"midpoint": (d["high"] + d["low"]) * 0.5, "ohlc4": (d["open"] + d["high"] + d["low"] + d["close"]) * 0.25})
    last = F.lag("close").over(own).cast("double")
    width = d["high"] - d["low"]
    rows = rows.withColumns({
        "v_midpoint": F.col("midpoint") - before("midpoint"), "v_ohlc4": F.col("ohlc4") - before("ohlc4"), "v_clv": 2.0 * (d["close"] - F.col("midpoint")),
        "true_range": F.greatest(width, F.abs(d["high"] - F.coalesce(last, d["high"])), F.abs(d["low"] - F.coalesce(last, d["low"]))),
        "volume_mean": F.avg(F.greatest(F.coalesce(F.col("volume").cast("double"), F.lit(1.0)), F.lit(0.0))).over(own.rowsBetween(-19, 0)),
    })
    mass = F.log1p(F.greatest(F.coalesce(F.col("volume").cast("double"), F.lit(1.0)), F.lit(0.0)) / F.greatest("volume_mean", F.lit(1.0))) / F.lit(float(np.log(2.0)))
    return rows.withColumns({"v_blend": 0.5 * (F.col("v_midpoint") + F.col("v_clv")), "volume_mass": F.greatest(mass, F.lit(0.1))})


def affine_scan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """y with y[i] = a[i] * y[i - 1] + b[i] and y[0] = b[0], in log2(n) vectorised steps.

    The maps y -> a y + b compose to such maps; each step composes every map with the one 1, 2, 4, ... before.
    An a of 0 starts anew, whatever came before.
    """
    a, b, step = a.copy(), b.copy(), 1
    while step < len(a):
        live = np.flatnonzero(a[step:]) + step
        if not len(live):
            break
        more, slope = a[live] * b[live - step], a[live] * a[live - step]
        b[live] += more
        a[live] = slope
        step *= 2
    return b


def _scanned(keys: tuple[str, ...], a: str, b: str, start: str, out: str):
    """A function over sorted Arrow batches: ``out`` is a * (out of the row before) + b; before a key's first row stands ``start``."""

    def run(batches):
        last, state = None, 0.0
        for batch in batches:
            if not batch.num_rows:
                continue
            slope, shift, before = (np.array(batch.column(c).to_numpy(zero_copy_only=False), float) for c in (a, b, start))
            new = np.zeros(batch.num_rows, bool)
            for key in keys:
                codes = batch.column(key).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
                new[1:] |= codes[1:] != codes[:-1]
            ends = [[batch.column(k)[i].as_py() for k in keys] for i in (0, batch.num_rows - 1)]
            new[0] = True
            if ends[0] == last:
                before[0] = state
            shift[new] += slope[new] * before[new]
            slope[new] = 0.0
            y = affine_scan(slope, shift)
            last, state = ends[1], float(y[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(y)], [*batch.schema.names, out])

    return run


def smoothed(bars: DataFrame, value: str, out: str, weight: float, group: tuple[str, ...] = ("symbol",), order: str = "ts", piece: str = "day") -> DataFrame:
    """bars with out[i] = out[i-1] + weight * (value[i] - out[i-1]), which starts with the first value.

    A null value is NaN; rows without a time come first.

    What a piece of a series (a day, a month) does to the state is a multiplication and a sum, both of which are
    aggregates of its rows. A scan over one row a piece finds the state that each piece starts with; one over
    the bars, piece by piece, is the result. A task holds a batch of its pieces' bars.
    """
    left, taken = 1.0 - weight, {c.lower() for c in bars.columns} & {"_piece", "_x", "_a", "_b", "_start", out.lower()}
    if taken:
        raise ValueError(f"columns exist already: {sorted(taken)}")
    series = F.struct(*group)
    x = F.coalesce(F.col(value).cast("double"), F.lit(float("nan")))
    rows = bars.withColumns({"_piece": F.coalesce(F.date_trunc(piece, order).cast("timestamp_ntz"), F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")), "_x": x})

    own = W.partitionBy("_piece", *group)
    placed = rows.select(*group, "_piece", "_x", F.row_number().over(own.orderBy(order)).alias("at"), F.count("*").over(own).alias("n"))
    sums = placed.groupBy("_piece", *group).agg(
        F.pow(F.lit(left), F.max("n")).alias("_a"), F.sum(F.col("_x") * weight * F.pow(F.lit(left), F.col("n") - F.col("at"))).alias("_b"), F.max(F.when(F.col("at") == 1, F.col("_x"))).alias("_start"),
    )
    # only the first piece's start, its first value, is taken; the others start where the one before ends
    sums = sums.repartition(*group).sortWithinPartitions(*group, "_piece")
    ends = sums.mapInArrow(_scanned(group, "_a", "_b", "_start", "_end"), T.StructType([*sums.schema.fields, T.StructField("_end", T.DoubleType())]))
    before = F.lag("_end").over(W.partitionBy(*group).orderBy("_piece"))
    starts = ends.select(series.alias("_of"), F.col("_piece").alias("_from"), F.coalesce(before, F.col("_start")).alias("_start"))

    rows = rows.join(starts, (series == F.col("_of")) & (F.col("_piece") == F.col("_from"))).drop("_of", "_from")
    rows = rows.withColumns({"_a": F.lit(left), "_b": F.col("_x") * weight}).repartition("_piece", *group).sortWithinPartitions("_piece", *group, order)
    done = rows.mapInArrow(_scanned((*group, "_piece"), "_a", "_b", "_start", out), T.StructType([*rows.schema.fields, T.StructField(out, T.DoubleType())]))
    return done.select(*(F.col(f"`{c}`") for c in bars.columns), out)


def ema(bars: DataFrame, value: str, out: str, period: int, **where) -> DataFrame:
    return smoothed(bars, value, out, 2.0 / (period + 1), **where)


def atr(featured: DataFrame, out: str = "atr", period: int = 14, **where) -> DataFrame:
    """Wilder's average of the true_range of features()."""
    return smoothed(featured, "true_range", out, 1.0 / period, **where)
