"""Queries of the bar operators over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CleanConfig, PivotConfig
from ..functions import indicators
from ..operators import bars, cleaning, compare, kalman, pieces, structure
from ..sources import fixtures, sinks
from ..sources.stored import drained
from ..streaming.rollup import stream_rollup as rollup_stream

STRICT, HALF_STRICT = PivotConfig(5, 5, True), PivotConfig(5, 5, False)
#: Columns of every step's input that the step queries show.
_SHOWN = ("src_row", "symbol", "instrument_id")


def _doubles(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in names})


def _ntz(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in names})


def bars_of(length: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bars.rollup(fixtures.ticks(spark, sf_dir), length)
    return _ntz(_doubles(out, "open", "high", "low", "close"), "ts").select("symbol", "ts", "open", "high", "low", "close", "volume")


hourly = partial(bars_of, "1 hour")


def stream_bars_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars by the streaming roll-up, of all that the stream has."""
    found = drained(rollup_stream(fixtures.tick_stream(spark, sf_dir), "1 hour"), "stream_bars", "complete")
    return _ntz(_doubles(found, "open", "high", "low", "close"), "ts").select("symbol", "ts", "open", "high", "low", "close", "volume")


def step(number: int, spark: SparkSession, sf_dir: str) -> DataFrame:
    """All input rows of a step with the reason it gives, KEPT if none."""
    result = cleaning.run_steps(fixtures.raw_rows(spark, sf_dir), last=number)[-1]
    return result.tagged.select(*_SHOWN, F.coalesce("reject_reason", F.lit("KEPT")).alias("reason"))


def _audit(number: int, name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.run_steps(fixtures.raw_rows(spark, sf_dir), last=number)[-1].audits[name]


def clean04_group_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(_audit(4, "groups", spark, sf_dir), "first_ts_utc", "last_ts_utc")


def clean05_symbol_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _audit(5, "symbols", spark, sf_dir)


def clean11_zero_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = cleaning.run_steps(fixtures.raw_rows(spark, sf_dir), last=11)[-1].kept
    return _ntz(kept.select(*_SHOWN, "ts_utc", F.col("volume").cast("long").alias("volume"), "zero_volume_flag"), "ts_utc")


def clean12_large_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    moves = _audit(12, "large_moves", spark, sf_dir)
    return _ntz(_doubles(moves, "previous_close").select(*_SHOWN, "previous_ts_utc", "previous_close", F.round("close_return_pct", 6).alias("close_return_pct"), F.col("minutes_since_previous").cast("long").alias("minutes_since_previous"), "anomaly_direction"), "previous_ts_utc")


def reject_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = cleaning.all_rejects(cleaning.run_steps(fixtures.raw_rows(spark, sf_dir), last=11))
    return rejects.groupBy("step", "reject_reason").agg(F.count("*").alias("n_rows"))


def clean_long_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three price steps' reasons for prices that have more digits than a decimal column."""
    rows = cleaning.price_reasons(fixtures.long_prices(spark, sf_dir), CleanConfig(), ("event_id",))
    found = {"price": F.col("r7"), **{k: F.when(F.col("r7").isNull(), F.col(r)) for k, r in (("envelope", "r8"), ("tick", "r9"))}}
    return rows.select("event_id", *(F.coalesce(r, F.lit("KEPT")).alias(k) for k, r in found.items()))


def pipeline_clean_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = cleaning.typed(cleaning.run_steps(fixtures.raw_rows(spark, sf_dir))[-1].kept)
    return _ntz(_doubles(kept, "open", "high", "low", "close"), "ts_utc")


def rollup_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-minute bars of the clean rows, by contract."""
    kept = cleaning.typed(cleaning.run_steps(fixtures.raw_rows(spark, sf_dir), last=11)[-1].kept)
    out = bars.rollup(kept, "5 minutes", ("publisher_id", "instrument_id", "symbol"), "ts_utc")
    return _ntz(_doubles(out, "open", "high", "low", "close"), "ts_utc")


def latest_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.latest_series(fixtures.ticks(spark, sf_dir))


def last_n_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 240 hourly bars of the series with the latest tick."""
    own = bars.of_series(hourly(spark, sf_dir), bars.latest_series(fixtures.ticks(spark, sf_dir)))
    return sinks.tail(own, 240, "ts")


def dedup_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks by minute and symbol: the last one."""
    rows = fixtures.ticks(spark, sf_dir).withColumn("ts", F.date_trunc("minute", "ts").cast("timestamp_ntz"))
    return _doubles(bars.dedup_last(rows), "close").select("symbol", "ts", "src_row", "close")


def range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.between(bars.valid_bars(hourly(spark, sf_dir)), "2024-01-05 00:00:00", "2024-01-10 12:00:00")


def _pivoted(config: PivotConfig, spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.pivots(hourly(spark, sf_dir), config)


def _zigzag(config: PivotConfig, spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.zigzag(_pivoted(config, spark, sf_dir))


def _only_pivots(df: DataFrame, *more: str) -> DataFrame:
    return df.where("pivot_kind is not null").select("symbol", "ts", "pivot_kind", "pivot_price", *more)


def pivots_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _only_pivots(_pivoted(STRICT, spark, sf_dir))


def pivots_half_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _only_pivots(_pivoted(HALF_STRICT, spark, sf_dir))


def zigzag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _only_pivots(_zigzag(STRICT, spark, sf_dir))


def hhll_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = structure.swing_flags(_zigzag(STRICT, spark, sf_dir))
    return flagged.select("symbol", "ts", "Higher_Low", "Higher_High", "Lower_Low", "Lower_High")


def hhll_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("Higher_Low", "Higher_High", "Lower_Low", "Lower_High")
    return hhll_flags(spark, sf_dir).groupBy("symbol").agg(*(F.sum(c).alias(c.lower()) for c in names))


def structure_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = structure.structure_labels(_zigzag(HALF_STRICT, spark, sf_dir), HALF_STRICT)
    return _only_pivots(labelled, "pivot_label", F.col("confirmed_at").cast("long").alias("confirmed_at"))


def _trended(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = structure.structure_labels(_zigzag(HALF_STRICT, spark, sf_dir), HALF_STRICT)
    return structure.trend(structure.levels(labelled, HALF_STRICT))


def structure_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trended(spark, sf_dir).select("symbol", "ts", "support", "resistance", "trend")


def break_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trended(spark, sf_dir).where("event is not null").select("symbol", "ts", "event", "event_level")


def trend_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.trend_now(_trended(spark, sf_dir))


def _in_pieces(config: PivotConfig, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole structure in pieces of 100 hours, so that every series has several here."""
    return pieces.structure(hourly(spark, sf_dir), config, rows=100, span="week")


def pieces_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_pieces(STRICT, spark, sf_dir).select("symbol", "ts", "Higher_Low", "Higher_High", "Lower_Low", "Lower_High")


def pieces_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _only_pivots(_in_pieces(HALF_STRICT, spark, sf_dir), "pivot_label", F.col("confirmed_at").cast("long").alias("confirmed_at"))


def pieces_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_pieces(HALF_STRICT, spark, sf_dir).select("symbol", "ts", "support", "resistance", "trend")


def pieces_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_pieces(HALF_STRICT, spark, sf_dir).where("event is not null").select("symbol", "ts", "event", "event_level")


def pieces_trend_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.trend_now(_in_pieces(HALF_STRICT, spark, sf_dir))


def multiset_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows before exact copies go against the rows that stay after the conflicts' step."""
    whole = cleaning.tagged_once(fixtures.raw_rows(spark, sf_dir), CleanConfig(), last=6)
    names = ("publisher_id", "instrument_id", "symbol", "ts_utc", "open", "high", "low", "close", "volume")
    kept = F.col("failed_step").isNull()
    return compare.compare_marked(whole.where(kept | (F.col("failed_step") >= 5)), names, F.lit(True), kept)


def multiset_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """multiset_compare by digests: of all rows' texts before the step of exact copies and after that of conflicts."""
    whole = cleaning.tagged_once(fixtures.raw_rows(spark, sf_dir), CleanConfig(), last=6)
    names = ("publisher_id", "instrument_id", "symbol", "ts_utc", "open", "high", "low", "close", "volume")
    kept = F.col("failed_step").isNull()
    return compare.compare_wide_marked(whole, names, kept | (F.col("failed_step") >= 5), kept)


def bar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("midpoint", "ohlc4", "v_midpoint", "v_ohlc4", "v_clv", "v_blend", "true_range", "volume_mean", "volume_mass")
    rows = indicators.features(hourly(spark, sf_dir))
    return rows.select("symbol", "ts", *(F.round(c, 6).alias(c) for c in names))


def pieces_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("midpoint", "ohlc4", "v_midpoint", "v_ohlc4", "v_clv", "v_blend", "true_range", "volume_mean", "volume_mass")
    return pieces.features(hourly(spark, sf_dir), rows=100, span="week").select("symbol", "ts", *(F.round(c, 6).alias(c) for c in names))


def ema_200(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indicators.ema(hourly(spark, sf_dir), "close", "ema_200", 200).select("symbol", "ts", F.round("ema_200", 6).alias("ema_200"))


def atr_14(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indicators.atr(indicators.features(hourly(spark, sf_dir)), "atr_14").select("symbol", "ts", F.round("atr_14", 6).alias("atr_14"))


def imm_kalman(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kalman.imm_kalman(hourly(spark, sf_dir))


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.ticks(spark, sf_dir).withColumn("ts", F.date_trunc("minute", "ts").cast("timestamp_ntz"))
    return bars.read_series(rows, first="2024-01-03 00:00:00", last="2024-01-28 12:00:00", tail=1000)


def read_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 1000 minutes in range of the series with the latest tick, one row a minute."""
    return _series(spark, sf_dir).select("symbol", "ts", "src_row", "close", "volume")


def imm_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filter over read_series."""
    return kalman.imm_kalman(_series(spark, sf_dir))


def imm_css_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = imm_kalman(spark, sf_dir)
    flips: list[Column] = [F.sum(c).alias(c + "s") for c in ("bull_flip", "bear_flip")]
    return found.groupBy("symbol").agg(F.count("*").alias("n_bars"), *flips, F.round(F.avg("observation_trust"), 6).alias("mean_trust"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = {"bars_1m": partial(bars_of, "1 minute"), "bars_5m": partial(bars_of, "5 minutes"), "bars_1h": hourly}
    steps = {1: "required", 2: "timestamps", 3: "symbols", 5: "duplicates", 6: "conflicts", 7: "prices", 8: "envelope", 9: "ticks", 10: "volume"}
    named |= {f"clean{n:02d}_{name}": partial(step, n) for n, name in steps.items()}
    plain = (
        stream_bars_1h, clean04_group_audit, clean05_symbol_conflicts, clean11_zero_volume, clean12_large_moves, clean_long_prices, reject_summary, pipeline_clean_all, rollup_clean, latest_contract,
        last_n_bars, dedup_last, range_filter, pivots_strict, pivots_half_strict, zigzag, hhll_flags, hhll_counts, structure_labels, structure_levels, break_events,
        trend_now, pieces_flags, pieces_labels, pieces_levels, pieces_events, pieces_trend_now, multiset_compare, multiset_digests, bar_features, pieces_features, ema_200, atr_14, imm_kalman, imm_css_summary, read_series, imm_series,
    )
    return named | {f.__name__: f for f in plain}
