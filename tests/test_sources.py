import pytest
from pyspark.sql import functions as F

from tallyforge.config import derived_path
from tallyforge.operators import bars, cleaning
from tallyforge.operators.cleaning import StepResult
from tallyforge.sources import sinks, tables


def test_csv(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('﻿ts,open,note\n1,2,"a ""b"",\nc"\n2,3,\n', encoding="utf-8")
    rows = tables.read_csv(spark, str(path), "any").collect()
    assert [(r["ts"], r["open"], r["note"], r["src_row"]) for r in rows] == [("1", "2", 'a "b",\nc', 2), ("2", "3", None, 3)]


def test_ragged(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("a,b\n1,2\n1\n")
    assert tables.read_csv(spark, str(path)).count() == 2
    assert tables.read_csv(spark, str(path), "long").select("a", "b").collect()[1]["b"] is None
    with pytest.raises(Exception, match="number of fields"):
        tables.read_csv(spark, str(path), "any").collect()
    path.write_text('a,b\n1,2\n1,"2,x",3\n')
    assert tables.read_csv(spark, str(path)).select("b").collect()[1]["b"] == "2,x"
    with pytest.raises(Exception, match="number of fields"):
        tables.read_csv(spark, str(path), "long").collect()


def test_headers(spark, tmp_path):
    path = tmp_path / "a.csv"
    for text, kw in (("a,a\n1,2\n", {}), ("a,b\n1,2\n", {"required": ("c",)}), ("a,src_row\n1,2\n", {})):
        path.write_text(text)
        with pytest.raises(ValueError):
            tables.read_csv(spark, str(path), **kw)


def test_aliases(spark):
    df = spark.createDataFrame([("t", 1, 2, 3, 4, 5)], "DateTime string, O int, H int, L int, Last int, vol int")
    assert tables.resolve(df).columns == ["ts", "open", "high", "low", "close", "volume"]
    with pytest.raises(ValueError):
        tables.resolve(df.drop("O"))


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "X")], "a int, reject_reason string")
    sinks.write_split(StepResult(df, {"twice": F.col("a") * 2}), str(tmp_path / "split"))
    assert {(r["a"], r["twice"], r["rejected"]) for r in spark.read.parquet(str(tmp_path / "split")).collect()} == {(1, 2, 0), (2, None, 1)}
    assert {r["reason"]: r["n_rows"] for r in sinks.reason_counts(df).collect()} == {"KEPT": 1, "X": 1}
    sinks.write_csv(df, str(tmp_path / "csv"))
    assert tables.read_csv(spark, str(tmp_path / "csv" / "*.csv"), numbered=False).count() == 2
    assert sinks.tail(df, None, "a").count() == 2
    with pytest.raises(ValueError):
        sinks.tail(df, 1, "a")
    assert (sinks.price_text(1234.5), sinks.price_text(7.0), sinks.safe_stem("a b/ü")) == ("1,234.5", "7", "a_b_ü")
    assert sinks.numbered_file(tmp_path, "m", "d", "t").name == "m_d_t_0001.svg"
    assert derived_path("x/raw.csv", 3).name == "raw_clean03.csv"


def test_steps_to_files(spark, sf, tmp_path):
    """Files and counts of a whole chain; the source is read once, all else is read from the tagged table."""
    from tallyforge.sources.fixtures import raw_rows

    source = str(tmp_path / "raw")
    raw_rows(spark, sf).write.parquet(source)
    results = cleaning.run_steps(spark.read.parquet(source))
    assert results.whole._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1
    done = sinks.write_steps(results, str(tmp_path / "out"))
    paths = done.paths
    assert sorted(paths) == ["groups", "kept", "large_moves", "rejects", "symbols", "tagged"] and paths["large_moves"].endswith("/Large_up_down")
    files = sorted((tmp_path / "out" / "kept").glob("*.csv"))
    rows = [line.split(",")[0] for f in files for line in f.read_text().splitlines() if line[0].isdigit()]
    assert len(rows) == 807 and rows == sorted(rows, key=int)
    rejects = spark.read.option("header", True).csv(paths["rejects"])
    assert rejects.count() == 1032 - 807 and {"failed_step", "ts_event", "reject_reason"} <= set(rejects.columns) and "ts_utc" not in rejects.columns
    assert (done.rows, done.kept, done.rejected[5, "EXACT_DUPLICATE"], done.rejected[6, "CONFLICT_DUPLICATE"]) == (1032, 807, 16, 36)
    assert done.rejected == {(r["failed_step"], r["reject_reason"]): r["count"] for r in spark.read.parquet(paths["tagged"]).where("failed_step is not null").groupBy("failed_step", "reject_reason").count().collect()}
    # once the tagged table stands, the source is no longer needed
    own = sinks.write_steps(cleaning.run_steps(spark.read.parquet(source), last=3), str(tmp_path / "three"), large_moves=str(tmp_path / "moves"))
    assert sorted(own.paths) == ["kept", "rejects", "tagged"] and own.kept == 945


def test_row_numbers(spark, tmp_path):
    for i in range(2):
        (tmp_path / f"{i}.csv").write_text("a\n1\n2\n")
    for multi_line in (True, False):
        rows = tables.read_csv(spark, str(tmp_path), multi_line=multi_line).collect()
        assert sorted((r["src_row"], r["a"]) for r in rows) == [(2, "1"), (3, "2"), (4, "1"), (5, "2")]


def test_row_numbers_of_split_files(spark, tmp_path, monkeypatch):
    """Files of several blocks, of one and of none, records of different lengths: numbers follow the records."""
    (tmp_path / "x").mkdir()
    value, want = 0, []
    for i, n in enumerate((3000, 0, 1, 1700)):
        lines = []
        for _ in range(n):
            value += 1
            lines.append(f"{value},{'y' * (value % 40)}")
            want.append((value + 1, str(value)))
        (tmp_path / "x" / f"{i}.csv").write_text("\n".join(["v,pad", *lines]) + "\n")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", 4000)
        spark.conf.set("spark.sql.files.openCostInBytes", 10)
        df = tables.read_csv(spark, str(tmp_path / "x"), "any", multi_line=False)
        assert spark.read.option("header", True).csv(str(tmp_path / "x")).rdd.getNumPartitions() > 10
        assert sorted((r["src_row"], r["v"]) for r in df.collect()) == want
        assert sorted(r["src_row"] for r in df.select("src_row").collect()) == [k for k, _ in want]
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        for most in (0, 10**6):
            monkeypatch.setattr(tables, "BROADCAST_ROWS", most)
            df = tables.read_csv(spark, str(tmp_path / "x"), multi_line=False)
            assert ("BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString()) == bool(most)
            assert sorted((r["src_row"], r["v"]) for r in df.collect()) == want
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_field_counts(spark):
    import csv
    import random
    import time

    rng = random.Random(1)
    records = ["", "a", ",", "a,b", '"a,b",c', '"a ""b"", c",d', '"",""', '5" disk,x', 'a""b,c', '"open,c', '"a",', '"""a""",b', '""",""",b']
    records += ["".join(rng.choices('a,"', k=rng.randint(1, 9))) for _ in range(300)]
    # those whose quoted fields are followed by a comma or the end, as writers make them
    sound = [r for r in records if all(f[:1] != '"' or f.count('"') % 2 == 0 for f in [r]) and list(csv.reader([r], strict=False)) and _regular(r)]
    df = spark.createDataFrame([(r,) for r in sound], "r string").select("r", tables.field_count(F.col("r")).alias("n"))
    assert len(sound) > 60
    for row in df.collect():
        assert row["n"] == max(1, len(next(csv.reader([row["r"]]), [""]))), row["r"]
    long = spark.createDataFrame([('"' + 'x,""' * 250_000 + '",' + "a,b" * 100_000,)], "r string")
    began = time.time()
    assert long.select(tables.field_count(F.col("r"))).first()[0] == 100_002
    assert time.time() - began < 10


def _regular(record):
    import re

    field = r'(?:"(?:[^"]|"")*"|[^",][^,]*|)'
    return re.fullmatch(f"{field}(?:,{field})*", record) is not None


def test_chart(spark, sf, tmp_path):
    from tallyforge.plans.queries import hourly

    out = tmp_path / "a.svg"
    sinks.candle_svg(hourly(spark, sf), out, "<t>", 60)
    text = out.read_text()
    assert text.count("<rect") == 61 and text.count('class="price"') == 6 and text.count('class="time"') == 8 and "&lt;t&gt;" in text
    trended = _trended_one(spark, sf)
    sinks.candle_svg(trended, out, "one", 400)
    text, rows = out.read_text(), sinks.tail(trended, 400, "ts").collect()
    pivots = [r for r in rows if r["pivot_kind"]]
    assert pivots and text.count("<circle") == len(pivots) and all(text.count(f">{x}<") == sum(r["pivot_label"] == x for r in pivots) for x in ("HH", "HL", "LH", "LL"))
    assert text.count('class="event"') == sum(r["event"] is not None for r in rows) > 0 and "trend" in text


def _trended_one(spark, sf):
    from tallyforge.plans.queries import _trended

    found = _trended(spark, sf)
    return found.where(F.col("symbol") == found.agg(F.min("symbol")).first()[0])


def test_choice_of_series(spark):
    df = spark.createDataFrame([("a", 1, 5, 1.0, 2.0, 0.5, 1.0), ("b", 2, 5, 1.0, 0.5, 0.5, 1.0), ("a", 3, 4, 1.0, 2.0, 0.5, None)], "symbol string, src_row int, ts int, open double, high double, low double, close double")
    assert bars.latest_series(df).first()["symbol"] == "a"
    assert bars.latest_series(df, symbol="b").first()["symbol"] == "b"
    assert bars.latest_series(df.where("false")).count() == 0
    assert bars.of_series(df, bars.latest_series(df)).count() == 2
    assert bars.valid_bars(df).count() == 1


def test_read_series(spark):
    rows = [("a", 1, 5, "1", "2", "0.5", "1", None), ("b", 2, 5, "1", "2", "1", "1", "-3"), ("a", 3, 4, "1", "2", "0.5", "x", "9"), ("a", 4, 5, "1", "2", "0.5", "2", "7"), ("a", 5, 3, "1", "0.9", "0.5", "1", "7"), ("a", 6, 1, "1", "1", "1", "1", "nan"), ("a", 7, None, "1", "1", "1", "1", "1"), ("a", 8, 2, "1", "1", "1", "1", "2")]
    df = spark.createDataFrame(rows, "symbol string, src_row int, d int, open string, high string, low string, close string, volume string")
    df = df.withColumn("ts", F.when(F.col("d").isNotNull(), F.make_timestamp_ntz(F.lit(2024), F.lit(1), "d", F.lit(0), F.lit(0), F.lit(0))))
    found = lambda **kw: sorted((r["src_row"], r["close"], r["volume"]) for r in bars.read_series(df, **kw).collect())
    assert found() == [(4, 2.0, 7.0), (6, 1.0, 1.0), (8, 1.0, 2.0)]
    assert found(symbol="b") == [(2, 1.0, 0.0)] and found(symbol="c") == []
    assert found(first="2024-01-02 00:00:00") == [(4, 2.0, 7.0), (8, 1.0, 2.0)] and found(tail=2) == [(4, 2.0, 7.0), (8, 1.0, 2.0)]
    assert [r["volume"] for r in bars.read_series(df.drop("volume"), symbol="b").collect()] == [1.0]
    for bad in ({"tail": 1}, {"symbol": "a"}):
        with pytest.raises(ValueError):
            bars.read_series(df if "tail" in bad else df.withColumnRenamed("symbol", "s"), group=("s",) if "symbol" in bad else ("symbol",), **bad)
