"""Structure over pieces of a series against the one-task forms and a sequential version."""

import pytest
from pyspark.sql import functions as F

from tallyforge.config import PivotConfig
from tallyforge.operators import pieces, structure
from tallyforge.sources import stored

from .test_structure import frame, random_bars, sequential

SIZES = (160, 7, 3, 200, 90, 131)


@pytest.fixture(scope="module")
def rows():
    return [r for k, n in enumerate(SIZES) for r in random_bars(k, n, f"S{k}")]


def one_task(df, config):
    kept = structure.zigzag(structure.pivots(df, config))
    return structure.trend(structure.levels(structure.structure_labels(structure.swing_flags(kept), config), config))


def table(df, *names):
    return sorted((tuple(r[c] for c in (*names, *pieces.RESULT)) for r in df.collect()), key=repr)


@pytest.mark.parametrize(("config", "size", "span"), [(PivotConfig(5, 5, True), 6, "day"), (PivotConfig(2, 7, False), 8, "day"), (PivotConfig(1, 1, True), 2, "hour"), (PivotConfig(3, 2, False), 1000, "month")])
def test_same_as_one_task(spark, rows, config, size, span):
    """Legs, levels and trends that span several pieces, down to pieces hardly longer than a pivot's side."""
    df = frame(spark, rows)
    found, usual = pieces.structure(df, config, rows=size, span=span), one_task(df, config)
    assert found.columns == [*df.columns, *pieces.RESULT]
    assert table(found, "symbol", "ts", "close") == table(usual, "symbol", "ts", "close")
    assert sorted(map(repr, pieces.trend_now(found).collect())) == sorted(map(repr, structure.trend_now(usual).collect()))


def test_against_the_sequential_version(spark, rows):
    config = PivotConfig(3, 2, False)
    got = pieces.structure(frame(spark, rows), config, rows=11, span="day").collect()
    for k in range(len(SIZES)):
        own = sorted((r for r in got if r["symbol"] == f"S{k}"), key=lambda r: r["i"])
        _, chosen, states, events = sequential([r for r in rows if r[0] == f"S{k}"], 3, 2, False)
        assert [[r["i"], r["pivot_kind"], r["pivot_price"]] for r in own if r["pivot_kind"]] == chosen
        assert [(r["i"], r["support"], r["resistance"], r["trend"]) for r in own] == states
        assert [(r["i"], r["event"], r["event_level"]) for r in own if r["event"] is not None] == events
        assert [r["bar"] for r in own] == list(range(len(own)))


def test_a_leg_over_many_pieces(spark):
    """One kind of pivot only for hundreds of bars: a leg whose best pivot is in the middle, pieces without pivots, a flat stretch."""
    wave = [100.0 + (k % 4 == 0) * (5 + (k == 120)) for k in range(240)] + [100.0] * 60 + [90.0 - (k % 5 == 2) for k in range(60)]
    rows = [("A", i, v, v, 50.0, v - 0.5, 1) for i, v in enumerate(wave)]
    for config in (PivotConfig(2, 2, True), PivotConfig(2, 2, False)):
        df = frame(spark, rows)
        assert table(pieces.structure(df, config, rows=5, span="day"), "ts") == table(one_task(df, config), "ts")


def test_two_sided_breaks_over_pieces(spark):
    """Support above resistance with closes between: every bar turns the trend, also over the ends of pieces."""
    flat = [(30, 20, 25)] * 3
    bars = flat + [(30, 28, 29)] * 2 + [(40, 33, 34)] + [(30, 27, 29)] * 3 + [(22, 5, 20)] + [(36, 26, 30)] * 3 + [(50, 26, 36)] * 60
    rows = [("A", i, float(c), float(h), float(lo), float(c), 1) for i, (h, lo, c) in enumerate(bars)]
    config = PivotConfig(2, 2, True)
    df = frame(spark, rows)
    assert table(pieces.structure(df, config, rows=4, span="day"), "ts") == table(one_task(df, config), "ts")


def test_null_keys_several_keys_and_no_rows(spark, rows):
    df = frame(spark, rows).withColumns({"symbol": F.when(F.col("symbol") != "S0", F.col("symbol")), "exchange": F.when(F.col("i") % 2 == 0, "X")})
    df = df.withColumn("ts", F.when(F.col("i") > 1, F.col("ts")))  # each series starts with a bar without a time
    key = ("symbol", "exchange")
    usual = structure.pivots(df, group=key)
    kept = structure.zigzag(usual, key)
    usual = structure.trend(structure.levels(structure.structure_labels(structure.swing_flags(kept, key), group=key), group=key), key)
    assert table(pieces.structure(df, group=key, rows=9, span="day"), "symbol", "exchange", "ts") == table(usual, "symbol", "exchange", "ts")
    assert pieces.structure(df.where("false"), group=key).collect() == []


def test_refused(spark, rows):
    df = frame(spark, rows[:20])
    with pytest.raises(ValueError, match="exist"):
        pieces.structure(df.withColumn("Trend", F.lit(1)))
    with pytest.raises(ValueError, match="piece"):
        pieces.structure(df, rows=5)


def test_no_task_has_a_whole_series(spark):
    """Each exchange of the result's plans is by series and span, or by series and piece; none by series alone over bars."""
    df = frame(spark, random_bars(1, 300))
    cut = pieces.Pieces(df, PivotConfig(), ("symbol",), "ts", 20, "day")
    plan = cut.legs(cut.pivoted())._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line]
    assert windows and all("_piece#" in w or "_span#" in w for w in windows)
    sizes = cut.pivoted().groupBy("_series", "_piece").count().agg(F.max("count")).first()[0]
    assert sizes == 20


def test_stored_tables_go(spark):
    from pathlib import Path

    df = stored.stored(spark.range(3), "three")
    folder = Path(stored._written[-1].removeprefix("file:"))
    path = Path("/" + str(folder).lstrip("/"))
    assert path.exists() and df.count() == 3
    stored.release(spark)
    assert not path.exists()


def test_features_over_pieces(spark, rows):
    from tallyforge.functions import indicators

    df = frame(spark, rows)
    found, usual = pieces.features(df, rows=20, span="day"), indicators.features(df)
    assert found.columns == usual.columns
    plain = lambda t: sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in t.collect()), key=repr)
    assert plain(found) == plain(usual)
