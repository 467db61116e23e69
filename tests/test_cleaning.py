import random
from datetime import datetime
from decimal import Decimal, InvalidOperation, localcontext

import pytest
from pyspark.sql import functions as F

from tallyforge.config import CleanConfig, load_clean_config
from tallyforge.functions import predicates as P
from tallyforge.operators import cleaning, compare

CONFIG = CleanConfig()


def reasons(spark, rows, names, reason):
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    return [r["reason"] for r in df.select(reason.alias("reason")).collect()]


def test_timestamps(spark):
    values = ["2024-01-02T03:04:00Z", " 2024-01-02T03:04:00.000000000Z\t", "2024-01-02T03:04:00", "2024-02-30T00:00:00Z", "2024-01-01T24:00:00Z", "0000-01-01T00:00:00Z",
              "2024-01-02T03:04:00.000000001Z", "2024-01-02T03:04:30Z", "2010-06-06T21:59:00Z", "2026-07-20T23:59:00.000000500Z", "2026-07-20T23:59:00.0000015Z", None, ""]
    got = reasons(spark, [(v,) for v in values], ["t"], P.stamp_reason(F.col("t"), CONFIG))
    i, o, a = "INVALID_TIMESTAMP", "TIMESTAMP_OUT_OF_RANGE", "TIMESTAMP_NOT_MINUTE_ALIGNED"
    assert got == [None, None, i, i, i, i, a, a, o, a, o, i, i]


def test_symbols(spark):
    values = [("nqu6 ", None), ("NQU6-NQZ6", None), ("NQU6 C20000", None), ("NQ P 100.5", None), ("ESU6", None), ("???", None), (" ", None), (None, None), ("NQU6", "opt"), ("NQU6", "Stock"), ("NQU6", " future ")]
    got = reasons(spark, values, ["s", "d"], P.symbol_reason(F.col("s"), [F.col("d")], CONFIG))
    assert got == [None, "FUTURES_SPREAD", "OPTION_INSTRUMENT", "OPTION_INSTRUMENT", "INVALID_PRODUCT", "INVALID_SYMBOL", "INVALID_SYMBOL", "INVALID_SYMBOL", "OPTION_INSTRUMENT", "INVALID_PRODUCT", None]


def test_prices_volume_and_grid(spark):
    rows = [("abc", "NaN", "1", "1", "1"), ("NaN", "-1", "1", "1", "1"), ("-0", "1", "1", "1", "-0.5"), ("1", "1", "1", " ", "1e3"), ("1.25", "1.5", "1", "1.25", "x"), ("1.25", "1.5", "1", "1.35", "1.5"), ("1", "1", "1", "-Infinity", "Inf")]
    names = ["open", "high", "low", "close", "volume"]
    assert reasons(spark, rows, names, P.price_reason()) == ["INVALID_PRICE", "NON_FINITE_PRICE", "NON_POSITIVE_PRICE", "INVALID_PRICE", None, None, "NON_FINITE_PRICE"]
    assert reasons(spark, rows, names, P.volume_reason()) == [None, None, "NEGATIVE_VOLUME", None, "INVALID_VOLUME", "NON_INTEGER_VOLUME", "INVALID_VOLUME"]
    assert reasons(spark, rows, names, P.tick_reason(CONFIG))[4:6] == [None, "INVALID_TICK_SIZE"]
    assert reasons(spark, rows, names, P.envelope_reason())[4:6] == [None, None]


def test_volumes_of_any_size(spark):
    values = ["1.000000001", "1000000000000", "1.0000000000000000001", "5.000", "1e25", "100000000000000000000.5", "-1e25", "1e-3", "12d", "1e999", ".5", "7.", None]
    f, n, i = "NON_INTEGER_VOLUME", "NEGATIVE_VOLUME", "INVALID_VOLUME"
    assert reasons(spark, [(v,) for v in values], ["volume"], P.volume_reason()) == [f, None, f, None, None, f, n, f, i, i, f, None, i]


def test_one_plan_and_single_steps_agree(spark):
    """Random dirty rows with definition columns and several publishers: the chain against its steps one by one."""
    rng = random.Random(5)
    rows = []
    for i in range(400):
        p = rng.choice([100.0, 100.25, 101.5])
        text = lambda v: rng.choice([f"{v:.2f}"] * 12 + [f"{v:.9f}1", "abc", "NaN", "-1", " ", f"{v + 0.1:.2f}"])  # noqa: B023, E731
        rows.append((i, rng.choice(["2024-01-01T%02d:%02d:00Z" % divmod(rng.randrange(900), 60)] * 9 + ["2024-01-01T00:00:30Z", "1999-01-01T00:00:00Z", "x"]), "33", rng.choice("12"), rng.choice("78"),
                     rng.choice(["NQH6"] * 9 + ["ESH6", " ", "NQH6-NQM6"]), text(p), text(p + 1), text(p - 1), text(p), rng.choice(["1", "2", "0", "1.5", "-3", "1.000000001", "1000000000000"]), rng.choice([None, "FUT", "OPT", "Stock"] + [None] * 5)))
    names = "src_row long, ts_event string, rtype string, publisher_id string, instrument_id string, symbol string, open string, high string, low string, close string, volume string, instrument_class string"
    rows += [(i + 1000, *r[1:]) for i, r in enumerate(rows[::9])]
    df = spark.createDataFrame(rows, names).repartition(3)
    whole = cleaning.run_steps(df)
    got = sorted(map(tuple, cleaning.all_rejects(whole).collect()))
    want, rest = [], df
    for n, step in enumerate(cleaning.STEPS, 1):
        own = step(rest, CONFIG)
        want += [(n, r["src_row"], r["reject_reason"]) for r in own.rejects.collect()]
        rest = own.kept
        assert whole[n - 1].kept.columns == rest.columns and sorted(map(tuple, whole[n - 1].kept.collect()), key=repr) == sorted(map(tuple, rest.collect()), key=repr)
        rest = spark.createDataFrame(rest.collect(), rest.schema)
    assert got == sorted(want) and {s for s, _, _ in got} >= {1, 2, 3, 5, 7, 9, 10}


@pytest.mark.parametrize("hot", [1, 3, 1000])
def test_hot_minutes(spark, hot):
    """Minutes with many rows, compared by sums: the same as by windows, whichever minutes are hot."""
    rng, rows = random.Random(hot), []
    for i in range(500):
        busy = i % 3 == 0
        minute = "2024-01-01T00:00:00Z" if busy else f"2024-01-01T{rng.randrange(3):02d}:{rng.randrange(60):02d}:00Z"
        p = 100.0 if busy and i % 2 else rng.choice([100.0, 100.25])
        rows.append((i, rng.choice([minute] * 20 + ["x"]), "33", rng.choice("12"), "7" if busy else rng.choice("78"), rng.choice(["NQH6"] * 5 + ["NQM6", " "]), f"{p:.2f}", f"{p + 1:.2f}", f"{p - 1:.2f}", f"{p:.2f}", rng.choice(["1", "1", "2"])))
    names = "src_row long, ts_event string, rtype string, publisher_id string, instrument_id string, symbol string, open string, high string, low string, close string, volume string"
    df = spark.createDataFrame(rows, names).repartition(3)
    for last in (5, 12):
        usual, split = (sorted(map(tuple, cleaning.tagged_once(df, CONFIG, last, hot=h).collect())) for h in (None, hot))
        assert split == usual and len(usual) == 500
    assert {r[-1] for r in usual} >= {"EXACT_DUPLICATE", "CONFLICT_DUPLICATE", "INVALID_TIMESTAMP"}


def test_nothing_is_lost(spark, sf):
    from tallyforge.sources.fixtures import raw_rows

    raw = raw_rows(spark, sf)
    results = cleaning.run_steps(raw)
    kept, rejects = results[-1].kept.count(), cleaning.all_rejects(results).count()
    assert kept + rejects == raw.count()
    counts = {r["reject_reason"]: r["n"] for r in cleaning.all_rejects(results).groupBy("reject_reason").agg(F.count("*").alias("n")).collect()}
    assert (raw.count(), kept, counts["INVALID_OHLC"], counts["CONFLICT_DUPLICATE"], counts["EXACT_DUPLICATE"]) == (1032, 807, 21, 36, 16)


def bars(spark, rows):
    df = spark.createDataFrame(rows, "src_row long, publisher_id string, instrument_id string, symbol string, ts string, open string, high string, low string, close string, volume string")
    return df.withColumn("ts_utc", F.col("ts").cast("timestamp_ntz")).drop("ts")


def test_duplicates_conflicts_and_gaps(spark):
    row = lambda i, ts, close="1", inst="7", sym="NQU6": (i, "1", inst, sym, f"2024-01-01 00:{ts}", "1", "1", "1", close, "1")
    df = bars(spark, [row(1, "00:00"), row(2, "00:00"), row(3, "01:00"), row(4, "01:00", "1.0"), row(5, "04:00"), row(6, "05:30"), row(7, "06:30", inst=None), row(8, "06:30", "2", inst=None), row(9, "07:00", sym="NQZ6")])
    five = cleaning.step05_exact_duplicates(df, CONFIG)
    assert [r["src_row"] for r in five.rejects.collect()] == [2]
    assert [tuple(r)[2:] for r in five.audits["symbols"].collect()] == [("NQU6", "NQZ6", 1, 9, 1)]
    six = cleaning.step06_conflicts(five.kept, CONFIG)
    assert sorted(r["src_row"] for r in six.rejects.collect()) == [3, 4]
    audit = {(r["instrument_id"], r["symbol"]): r for r in cleaning.group_audit(df.where("src_row < 7")).collect()}[("7", "NQU6")]
    assert (audit["row_count"], audit["duplicate_timestamp_rows"], audit["gap_count"], audit["missing_minutes"]) == (6, 2, 2, 2)


def test_fail_fast(spark):
    df = bars(spark, [(1, "1", "7", " ", "2024-01-01 00:00:00", "1", "1", "1", "1", "1.5")])
    with pytest.raises(Exception, match="blank"):
        cleaning.step04_order_and_gaps(df, CONFIG).kept.collect()
    with pytest.raises(Exception, match="whole number"):
        cleaning.step11_zero_volume(df, CONFIG).kept.collect()


def test_multisets(spark):
    left, right = (spark.createDataFrame([(x,) for x in xs], "v string") for xs in (["a", "a", "b"], ["a", "c"]))
    assert tuple(compare.multiset_compare(left, right).first()) == (3, 2, 1, 2, 1)
    with pytest.raises(ValueError):
        compare.multiset_compare(left, right.toDF("w"))


@pytest.mark.parametrize("bits", [64, 2, 0])
def test_multisets_by_digests(spark, monkeypatch, bits):
    """Exact totals, also where digests collide: all rows under a few digests, or one."""
    if bits < 64:
        usual = compare.row_digest
        monkeypatch.setattr(compare, "row_digest", lambda c, salt: usual(c, salt).bitwiseAND((1 << bits) - 1))
    rng = random.Random(bits)
    make = lambda n: spark.createDataFrame([(rng.choice(["a", "b", "", None]), rng.choice([None, "a", "", "long " * 50]), rng.choice([1, 2, None])) for _ in range(n)], "`x.y` string, z string, n int")
    for left, right in ((make(300), make(260)), (make(50).where("false"), make(40)), (make(50).where("false"), make(1).where("false"))):
        left, right = (spark.createDataFrame(t.collect(), t.schema) for t in (left, right))
        assert compare.compare_wide(left, right).collect() == compare.multiset_compare(left.withColumnRenamed("x.y", "x"), right.withColumnRenamed("x.y", "x")).collect()
    same = make(200)
    same = spark.createDataFrame(same.collect(), same.schema)
    assert tuple(compare.compare_wide(same, same.orderBy(F.rand())).first()) == (200, 200, 200, 0, 0)
    with pytest.raises(ValueError):
        compare.compare_wide(same, same.drop("n"))


def test_config(tmp_path):
    path = tmp_path / "c.json"
    path.write_text('{"tick": "0.5", "last_utc": "2024-01-01 01:00:00+01:00", "root": "ES"}')
    got = load_clean_config(path)
    assert (str(got.tick), got.last_utc, got.root) == ("0.5", "2024-01-01 00:00:00", "ES")
    path.write_text('''{"input_path": "raw.csv", "required_columns": ["ts_event"], "encoding": "latin-1", "clean02": {"default_output_dir": "x", "download_start_utc": "2011-01-01 01:00:00+01:00"},
        "clean03": {"option_definition_values": ["opt"]}, "clean04": {"group_columns": ["symbol"]}, "clean09": {"tick_size": "0.5"}, "clean12": {"return_threshold_pct": "2.5", "large_up_down_output_path": "moves"}, "clean05": {"timestamp_column": "ts_utc"}}''')
    got = load_clean_config(path)
    assert (got.input_path, got.required, got.encoding, got.first_utc) == (str(tmp_path / "raw.csv"), ("ts_event",), "latin-1", "2011-01-01 00:00:00")
    assert (got.option_values, got.group, str(got.tick), str(got.move_pct)) == (("OPT",), ("symbol",), "0.5", "2.5")
    assert got.large_moves_path == str(tmp_path / "moves")
    for bad in ('{"clean09": {"tick_sise": "0.5"}}', '{"clean13": {}}', '{"clean04": {"timestamp_column": "x"}}', '{"tick": "0"}', '{"first_utc": "2024-01-01 00:00:00"}', '{"what": 1}', "{"):
        path.write_text(bad)
        with pytest.raises(ValueError):
            load_clean_config(path)


def sequential_audit(rows):
    """(key, rows, first, last, repeated, gaps, missing) by a walk over the rows."""
    out = {}
    for _, _, inst, sym, ts, *_ in sorted(rows, key=lambda r: (r[4], r[0])):
        at = datetime.fromisoformat(ts)
        n, first, last, same, gaps, missing = out.get((inst, sym), (0, at, None, 0, 0, 0))
        wait = None if last is None else (at - last).total_seconds()
        gap = wait is not None and wait > 60
        out[inst, sym] = (n + 1, first, at, same + (wait == 0), gaps + gap, missing + (int(wait // 60) - 1 if gap else 0))
    return out


def test_audits_over_days(spark):
    """Series of many days with one row or several a day, repeated times at both ends of a day, a null symbol."""
    rng, rows = random.Random(6), []
    for i in range(500):
        day, minute = rng.choice([(1, 0), (1, 1439), (2, 0), (2, 1439), (rng.randint(1, 28), rng.randrange(1440))])
        rows.append((i, "1", rng.choice("789"), rng.choice(["NQU6", None]), f"2024-01-{day:02d} {minute // 60:02d}:{minute % 60:02d}:00", "1", "1", "1", str(rng.randint(90, 110)), "1"))
    rows += [(900 + d, "1", "one a day", "NQU6", f"2024-02-{d:02d} 00:00:00", "1", "1", "1", str(100 + d % 3), "1") for d in (1, 2, 3, 7, 8)]
    df = bars(spark, rows).repartition(5)
    names = ("row_count", "first_ts_utc", "last_ts_utc", "duplicate_timestamp_rows", "gap_count", "missing_minutes")
    for span in ("hour", "day", "year"):
        assert {(r["instrument_id"], r["symbol"]): tuple(r[c] for c in names) for r in cleaning.group_audit(df, span=span).collect()} == sequential_audit(rows)
    want, last = [], {}
    for r in sorted(rows, key=lambda r: (r[4], r[0])):
        if (before := last.get(r[2:4])) and abs(int(r[8]) - int(before[8])) * 100 >= int(before[8]):
            want.append((r[0], before[4], float(before[8]), "LARGE_UP" if int(r[8]) > int(before[8]) else "LARGE_DOWN"))
        last[r[2:4]] = r
    got = cleaning.large_moves(df, CONFIG).collect()
    assert sorted((r["src_row"], str(r["previous_ts_utc"]), float(r["previous_close"]), r["anomaly_direction"]) for r in got) == sorted(want)
    assert cleaning.group_audit(df.where("false")).collect() == [] and cleaning.large_moves(df.where("false"), CONFIG).collect() == []


def usual_reasons(row, tick=Decimal("0.25"), tolerance=Decimal("0.000001")):
    """Reasons of the three price steps by Python's decimals, with digits enough for every price."""
    values = []
    for text in row:
        try:
            values.append(Decimal((text or "").strip()))
        except InvalidOperation:
            return "INVALID_PRICE", None, None
    if not all(v.is_finite() for v in values):
        return "NON_FINITE_PRICE", None, None
    if any(v <= 0 for v in values):
        return "NON_POSITIVE_PRICE", None, None
    o, h, lo, c = values
    with localcontext(prec=400):
        off = any(abs(v / tick - (v / tick).to_integral_value()) >= tolerance for v in values)
    return None, None if lo <= min(o, c) and max(o, c) <= h else "INVALID_OHLC", "INVALID_TICK_SIZE" if off else None


def test_prices_of_any_length(spark):
    """Nine and more decimals, thirteen and more digits, exponents: against Python's decimals."""
    rng, rows = random.Random(9), []
    odd = ["1e3", "25E-2", "0.25000000", "0.2500000000000000001", "0.24999999999999999", "1000000000000000000000000000000.25", "1000000000000000000000000000000.26", "123456789012345678901234567890.75",
           "0.250000249999999999999999999999999999", "0.25000025", "0.250000250000000000000000000000000001", "0.24999975", "0.249999750000000000000000000000000001", "7.5e30", "1e-30", "0000000000000000001.5", "5e100", "1e-400",
           ".5", "7.", "+1.25", "-1.25", "-0.00000000000001", "0.000000000000", "0e5", "nan", "Infinity", "1e", "", None, "1 2", "12345678901234.5", "250000000000000.0000000000000000"]
    for text in odd:
        rows += [(text,) * 4, ("1.25", text, "1", "1.25")]
    for _ in range(400):
        base = rng.choice(["1.25", "1.250000000000", "100000000000000.5", "100000000000000.50000000000001", "1.0e14", "99999999999999.75", "1e14", "100000000000000.4999999"])
        rows.append(tuple(rng.choice([base, base, rng.choice(odd) or "x"]) for _ in range(4)))
    names = ["open", "high", "low", "close"]
    got = list(zip(*(reasons(spark, rows, names, r) for r in (P.price_reason(), P.envelope_reason(), P.tick_reason(CONFIG))), strict=True))
    for row, (seven, eight, nine) in zip(rows, got, strict=True):
        want = usual_reasons(row)
        assert seven == want[0], row
        if seven is None:
            assert (eight, nine) == want[1:], row
    assert {g[0] for g in got} == {None, "INVALID_PRICE", "NON_FINITE_PRICE", "NON_POSITIVE_PRICE"}


@pytest.mark.parametrize(("tick", "tolerance"), [("0.25", "0.000001"), ("0.01", "0"), ("9999.99999999", "0.0000000001"), ("7", "0.3")])
def test_price_steps_in_layers(spark, tick, tolerance):
    """price_reasons() against Python's decimals: no, one or many digits behind and before, far exponents, white space, other ticks."""
    config, rng, rows = CleanConfig(tick=Decimal(tick), tick_tolerance=Decimal(tolerance)), random.Random(tick), []
    odd = ["1e3", "25E-2", "1E+3", " +1.25", "\t7.\r\n", "2.5000000000\u2028", "0.25000025", "0.249999750000000000000000000000000001", "1e-30", "1e-400", "1e300", "123e17", "7e123", "0." + "0" * 40 + "1", "9" * 45, "1" * 31 + ".25",
           "25" + "0" * 29, "8" * 18 + ".123456789", "-1.25", "0.000000000000", "0e5", "sNaN", "-inf", "1e", "", " ", None, "1 2", "1.2.3", "1+", "12345678901234.5", "9999.99999999", "19999.99999998000", "9999.999999990000000000000000001"]
    rows += [(text,) * 4 for text in odd] + [(text, "1.25", "1", text) for text in odd]
    for _ in range(300):
        whole, base = rng.choice(["1", "100", "1000000000100", "9" * 20, "4" * 33]), rng.choice([".25", ".250000000000", ".25000025", ".2500000000000000000001", "", "e21", "E-9"])
        rows.append(tuple(rng.choice([whole + base] * 5 + ["9" + whole + base, rng.choice(odd)]) for _ in range(4)))
    df = spark.createDataFrame(rows, "open string, high string, low string, close string")
    found = cleaning.price_reasons(df, config)
    assert found.columns == ["open", "high", "low", "close", "r7", "r8", "r9"]
    for r in found.collect():
        want = usual_reasons(r[:4], config.tick, config.tick_tolerance)
        assert r["r7"] == want[0] and (r["r7"] or tuple(r[5:]) == want[1:]), r
    assert cleaning.price_reasons(df, config, ("close",)).columns == ["close", "r7", "r8", "r9"] and cleaning.price_reasons(df.where("false"), config).collect() == []
    assert found.where("r9 is null and r7 is null").count() == sum(not (r["r7"] or r["r9"]) for r in found.collect())


def test_long_prices_plan_repeats_nothing(spark, sf):
    """Each price is matched by few patterns, filtered or not, and no remainder takes a fixed number of rounds."""
    from tallyforge.plans.queries import clean_long_prices

    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        found = clean_long_prices(spark, sf)
        plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (found, found.where("tick = 'KEPT' and envelope = 'KEPT'"))]
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    for plan in plans:
        assert 0 < plan.count("RLIKE") <= 20 and "regexp_extract" not in plan and "sequence(1, 60" not in plan and len(plan) < 60_000
