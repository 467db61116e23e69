"""Comparing tables as multisets of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.stored import stored


def row_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every different row with its number on either side; both counts come of one shuffle."""
    if left.columns != right.columns:
        raise ValueError(f"different columns: {left.columns} and {right.columns}")
    both = left.select("*", F.lit(1).alias("n_left"), F.lit(0).alias("n_right")).union(right.select("*", F.lit(0), F.lit(1)))
    return both.groupBy(*left.columns).agg(F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right"))


def multiset_compare(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: total_left, total_right, common, left_only, right_only; order counts for nothing, copies do."""
    return _totals(row_counts(left, right))


def compare_marked(df: DataFrame, columns: tuple[str, ...], left: Column, right: Column) -> DataFrame:
    """multiset_compare() of two parts of one table, which may overlap: its rows of ``left`` and those of ``right``."""
    return _totals(df.groupBy(*columns).agg(F.count_if(left).alias("n_left"), F.count_if(right).alias("n_right")))


def row_digest(columns: tuple[str, ...], salt: int) -> Column:
    """64 bits of a row; nulls count, and which columns have them."""
    cells = [F.col(f"`{c}`") for c in columns]
    return F.xxhash64(F.lit(salt), *cells, *(c.isNull() for c in cells))


def compare_wide_marked(df: DataFrame, columns: tuple[str, ...], left: Column, right: Column) -> DataFrame:
    """compare_marked() that shuffles digests instead of rows; the totals are exact all the same.

    Rows are counted by 128 bits of digest, with the least and greatest of a further digest. Where a digest has as
    many rows on either side, and one further digest, its rows are settled. The rows of all others (those that
    differ, and those of different rows under one digest) are compared as they are: a semi-join finds them, for
    which their digests are sent to all executors if they are few (Spark knows the size of the stored table).
    """
    marked = df.where(left | right).withColumns({"_d1": row_digest(columns, 1), "_d2": row_digest(columns, 2), "_left": left.cast("int"), "_right": right.cast("int")})
    slim = marked.select("_d1", "_d2", row_digest(columns, 3).alias("_d3"), "_left", "_right")
    found = slim.groupBy("_d1", "_d2").agg(F.sum("_left").alias("n_left"), F.sum("_right").alias("n_right"), F.min("_d3").alias("_least"), F.max("_d3").alias("_most"))
    found = stored(found, "digests")
    settled = (F.col("n_left") == F.col("n_right")) & (F.col("_least") == F.col("_most"))
    open_ones = stored(found.where(~settled).select("_d1", "_d2"), "open")
    rest = marked.join(open_ones, ["_d1", "_d2"], "left_semi").groupBy(*(F.col(f"`{c}`") for c in columns)).agg(F.sum("_left").alias("n_left"), F.sum("_right").alias("n_right"))
    return _totals(found.where(settled).select("n_left", "n_right").unionByName(rest.select("n_left", "n_right")))


def compare_wide(left: DataFrame, right: DataFrame) -> DataFrame:
    """multiset_compare() of tables with long rows, see compare_wide_marked()."""
    if left.columns != right.columns:
        raise ValueError(f"different columns: {left.columns} and {right.columns}")
    both = left.withColumn("_side", F.lit(True)).unionByName(right.withColumn("_side", F.lit(False)))
    return compare_wide_marked(both, tuple(left.columns), F.col("_side"), ~F.col("_side"))


def _totals(counts: DataFrame) -> DataFrame:
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return counts.agg(
        zero("n_left").alias("total_left"), zero("n_right").alias("total_right"), zero(F.least("n_left", "n_right")).alias("common"),
        zero(F.greatest(F.col("n_left") - F.col("n_right"), F.lit(0))).alias("left_only"), zero(F.greatest(F.col("n_right") - F.col("n_left"), F.lit(0))).alias("right_only"),
    )
