"""DuckDB SQL of the queries, over whole tables."""

from __future__ import annotations

_RULES = (
    (97, "r01"), (89, "r02a"), (83, "r02b"), (79, "r02c"), (73, "r03a"), (71, "r03b"), (67, "r03c"), (61, "r05"), (59, "r06"),
    (53, "r07"), (47, "r08"), (43, "r09"), (41, "r10"), (37, "r11"), (29, "r05s"),
)


def _bars(name: str, unit: str) -> str:
    return f"""{name} AS (
  SELECT event_type AS symbol, time_bucket(INTERVAL '{unit}', ts) AS ts,
    CAST(arg_min(CAST(value AS DECIMAL(18,2)), ROW(e.ts, event_id)) AS DOUBLE) AS open, CAST(max(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS high,
    CAST(min(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS low, CAST(arg_max(CAST(value AS DECIMAL(18,2)), ROW(e.ts, event_id)) AS DOUBLE) AS close,
    count(*) AS volume FROM events e GROUP BY ALL)"""


_HOURLY = _bars("h", "1 hour")

_RAW = f"""e AS (
  SELECT event_id AS id, user_id AS u, date_trunc('minute', ts) AS m,
    CAST(100 + round(CAST(value AS DECIMAL(18,2)) * 4) / 4 AS DECIMAL(18,2)) AS p,
    CASE {" ".join(f"WHEN event_id % {by} = 0 THEN '{name}'" for by, name in _RULES)} END AS rule,
    CASE user_id % 4 WHEN 0 THEN 'NQH6' WHEN 1 THEN 'NQM6' WHEN 2 THEN 'NQU6' ELSE 'NQZ6' END AS usual
  FROM events),
d AS (SELECT e.*, 0 AS k FROM e UNION ALL SELECT e.*, 1 AS k FROM e WHERE rule IN ('r05', 'r06')),
raw AS (
  SELECT id * 2 + k AS src_row,
    CASE rule WHEN 'r02a' THEN strftime(m, '%Y-%m-%dT%H:%M:%S') WHEN 'r02b' THEN strftime(m, '1999-%m-%dT%H:%M:%S.000000000Z')
      WHEN 'r02c' THEN strftime(m, '%Y-%m-%dT%H:%M:30.000000000Z') ELSE strftime(m, '%Y-%m-%dT%H:%M:%S.000000000Z') END AS ts_event,
    '33' AS rtype, '1' AS publisher_id, CAST(u AS VARCHAR) AS instrument_id,
    CASE WHEN rule = 'r07' THEN CASE id % 3 WHEN 0 THEN 'abc' WHEN 1 THEN 'NaN' ELSE '-1' END ELSE CAST(p AS VARCHAR) END AS open,
    CAST(CAST(CASE WHEN rule = 'r08' THEN p - 1.25 ELSE p + 1 END AS DECIMAL(18,2)) AS VARCHAR) AS high,
    CAST(CAST(p - 0.25 AS DECIMAL(18,2)) AS VARCHAR) AS low,
    CAST(CAST(CASE rule WHEN 'r09' THEN p + 0.10 WHEN 'r06' THEN p + 0.25 * k ELSE p END AS DECIMAL(18,2)) AS VARCHAR) AS close,
    CASE rule WHEN 'r10' THEN CASE id % 3 WHEN 0 THEN 'x' WHEN 1 THEN '-3' ELSE '1.5' END WHEN 'r11' THEN '0' ELSE CAST(1 + id % 500 AS VARCHAR) END AS volume,
    CASE rule WHEN 'r01' THEN ' ' WHEN 'r03a' THEN 'NQU6-NQZ6' WHEN 'r03b' THEN 'NQU6 C20000' WHEN 'r03c' THEN CASE WHEN id % 2 = 0 THEN 'ESU6' ELSE '???' END
      WHEN 'r05s' THEN CASE WHEN usual = 'NQZ6' THEN 'NQH7' ELSE 'NQZ6' END ELSE usual END AS symbol
  FROM d)"""

_PRICES = ("open", "high", "low", "close")
_OHLCV = (*_PRICES, "volume")
_NUM = {c: f"TRY_CAST({c} AS DECIMAL(20,8))" for c in _OHLCV}
_ODD = {c: f"regexp_full_match(lower(trim({c})), '[+-]?(nan|inf|infinity)')" for c in _PRICES}


def _or(parts: list[str]) -> str:
    return "(" + " OR ".join(parts) + ")"


#: For each step the columns that it adds before it decides, and its reason.
_REASONS = {
    1: ("*", "CASE WHEN " + _or([f"trim({c}) = ''" for c in ("ts_event", "rtype", "publisher_id", "instrument_id", "symbol", *_OHLCV)]) + " THEN 'MISSING_REQUIRED_FIELD' END"),
    2: (
        "* EXCLUDE (ts_event), CASE WHEN regexp_full_match(ts_event, '\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}(\\.\\d{1,9})?Z') THEN TRY_CAST(replace(substr(ts_event, 1, 19), 'T', ' ') AS TIMESTAMP) END AS ts_utc",
        "CASE WHEN ts_utc IS NULL THEN 'INVALID_TIMESTAMP' WHEN ts_utc NOT BETWEEN TIMESTAMP '2010-06-06 22:00:00' AND TIMESTAMP '2026-07-20 23:59:00' THEN 'TIMESTAMP_OUT_OF_RANGE' WHEN second(ts_utc) <> 0 THEN 'TIMESTAMP_NOT_MINUTE_ALIGNED' END",
    ),
    3: (
        "*",
        "CASE WHEN trim(symbol) = '' THEN 'INVALID_SYMBOL' WHEN regexp_full_match(symbol, 'NQ[HMUZ]\\d{1,2}-NQ[HMUZ]\\d{1,2}') THEN 'FUTURES_SPREAD' WHEN regexp_full_match(symbol, 'NQ([HMUZ]\\d{1,2})?\\s*[CP]\\s*\\d+(\\.\\d+)?') THEN 'OPTION_INSTRUMENT' "
        "WHEN regexp_full_match(symbol, 'NQ[HMUZ]\\d{1,2}') THEN NULL WHEN regexp_full_match(symbol, '[A-Z]{1,6}[HMUZ]\\d{1,2}') THEN 'INVALID_PRODUCT' ELSE 'INVALID_SYMBOL' END",
    ),
    4: ("*", "CAST(NULL AS VARCHAR)"),
    5: ("*, row_number() OVER (PARTITION BY publisher_id, instrument_id, symbol, ts_utc, open, high, low, close, volume ORDER BY src_row) AS rn", "CASE WHEN rn > 1 THEN 'EXACT_DUPLICATE' END"),
    6: ("* EXCLUDE (rn)", "CASE WHEN (publisher_id, instrument_id, ts_utc) IN (SELECT (publisher_id, instrument_id, ts_utc) FROM s05 GROUP BY publisher_id, instrument_id, ts_utc HAVING count(*) > 1 AND " + _or([f"min({c}) <> max({c})" for c in _OHLCV]) + ") THEN 'CONFLICT_DUPLICATE' END"),
    7: ("*", f"CASE WHEN {_or([f'({_NUM[c]} IS NULL AND NOT {_ODD[c]})' for c in _PRICES])} THEN 'INVALID_PRICE' WHEN {_or([_ODD[c] for c in _PRICES])} THEN 'NON_FINITE_PRICE' WHEN {_or([f'{_NUM[c]} <= 0' for c in _PRICES])} THEN 'NON_POSITIVE_PRICE' END"),
    8: ("*", f"CASE WHEN NOT ({_NUM['low']} <= least({_NUM['open']}, {_NUM['close']}) AND greatest({_NUM['open']}, {_NUM['close']}) <= {_NUM['high']}) THEN 'INVALID_OHLC' END"),
    9: ("*", "CASE WHEN " + _or([f"abs({_NUM[c]} / 0.25 - round({_NUM[c]} / 0.25)) >= 0.000001" for c in _PRICES]) + " THEN 'INVALID_TICK_SIZE' END"),
    10: ("*", f"CASE WHEN {_NUM['volume']} IS NULL THEN 'INVALID_VOLUME' WHEN {_NUM['volume']} < 0 THEN 'NEGATIVE_VOLUME' WHEN {_NUM['volume']} <> floor({_NUM['volume']}) THEN 'NON_INTEGER_VOLUME' END"),
    11: ("*, CAST(TRY_CAST(volume AS DECIMAL(20,8)) = 0 AS INTEGER) AS zero_volume_flag", "CASE WHEN TRY_CAST(volume AS DECIMAL(20,8)) < 0 THEN 'NEGATIVE_VOLUME' END"),
    12: ("*", "CAST(NULL AS VARCHAR)"),
}


def _steps(last: int) -> str:
    """CTEs raw, t01 (tagged), s01 (kept), ..., up to step ``last``."""
    out, before = [_RAW], "raw"
    for n in range(1, last + 1):
        add, reason = _REASONS[n]
        out.append(f"t{n:02d} AS (SELECT *, {reason} AS reason FROM (SELECT {add} FROM {before}))")
        out.append(f"s{n:02d} AS (SELECT * EXCLUDE (reason) FROM t{n:02d} WHERE reason IS NULL)")
        before = f"s{n:02d}"
    return "WITH " + ",\n".join(out)


def _tagged(n: int) -> str:
    return f"{_steps(n)}\nSELECT src_row, symbol, instrument_id, coalesce(reason, 'KEPT') AS reason FROM t{n:02d}"


_GROUP = "publisher_id, instrument_id, symbol"


def _pivots(strict: bool) -> str:
    up, down = (">", "<") if strict else (">=", "<=")
    return f"""{_HOURLY},
w AS (SELECT *, row_number() OVER s - 1 AS bar, count(*) OVER l AS nl, count(*) OVER r AS nr, max(high) OVER l AS hl, max(high) OVER r AS hr, min(low) OVER l AS ll, min(low) OVER r AS lr
  FROM h WINDOW s AS (PARTITION BY symbol ORDER BY ts), l AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), r AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING)),
c AS (SELECT *, CASE WHEN nl = 5 AND nr = 5 AND high > hl AND high {up} hr THEN 'high' WHEN nl = 5 AND nr = 5 AND low < ll AND low {down} lr THEN 'low' END AS pivot_kind FROM w),
pv AS (SELECT *, CASE pivot_kind WHEN 'high' THEN high WHEN 'low' THEN low END AS pivot_price FROM c)"""


def _kept(strict: bool) -> str:
    return f"""{_pivots(strict)},
only_p AS (SELECT *, CASE WHEN pivot_kind = lag(pivot_kind) OVER (PARTITION BY symbol ORDER BY ts) THEN 0 ELSE 1 END AS turn FROM pv WHERE pivot_kind IS NOT NULL),
legs AS (SELECT *, sum(turn) OVER (PARTITION BY symbol ORDER BY ts) AS leg FROM only_p),
z AS (SELECT * FROM legs QUALIFY row_number() OVER (PARTITION BY symbol, leg ORDER BY CASE pivot_kind WHEN 'high' THEN -pivot_price ELSE pivot_price END, ts) = 1),
zl AS (SELECT *, lag(pivot_price) OVER (PARTITION BY symbol, pivot_kind ORDER BY ts) AS before FROM z),
lab AS (SELECT *, CASE pivot_kind WHEN 'high' THEN CASE WHEN before IS NULL OR pivot_price > before THEN 'HH' ELSE 'LH' END ELSE CASE WHEN before IS NULL OR pivot_price > before THEN 'HL' ELSE 'LL' END END AS pivot_label, bar + 5 AS confirmed_at FROM zl)"""


_FLAGS = f"""WITH {_kept(True)},
f AS (SELECT h.symbol, h.ts, CAST(coalesce(pivot_kind = 'low' AND pivot_price > before, false) AS INTEGER) AS "Higher_Low", CAST(coalesce(pivot_kind = 'high' AND pivot_price > before, false) AS INTEGER) AS "Higher_High",
  CAST(coalesce(pivot_kind = 'low' AND pivot_price < before, false) AS INTEGER) AS "Lower_Low", CAST(coalesce(pivot_kind = 'high' AND pivot_price < before, false) AS INTEGER) AS "Lower_High" FROM h LEFT JOIN zl ON h.symbol = zl.symbol AND h.ts = zl.ts)"""

_TREND = f"""WITH {_kept(False)},
lv AS (SELECT w.symbol, w.ts, w.bar, w.close,
    last_value(CASE WHEN lab.pivot_kind = 'low' THEN lab.pivot_price END IGNORE NULLS) OVER o AS support, last_value(CASE WHEN lab.pivot_kind = 'high' THEN lab.pivot_price END IGNORE NULLS) OVER o AS resistance
  FROM w LEFT JOIN lab ON w.symbol = lab.symbol AND w.bar = lab.confirmed_at WINDOW o AS (PARTITION BY w.symbol ORDER BY w.bar ROWS UNBOUNDED PRECEDING)),
fl AS (SELECT *, coalesce(close > resistance, false) AS up, coalesce(close < support, false) AS down FROM lv),
an AS (SELECT *, CASE WHEN up AND NOT down THEN 1 WHEN down AND NOT up THEN -1 END AS setting FROM fl),
st AS (SELECT *, last_value(setting IGNORE NULLS) OVER o AS anchor, count(setting) OVER o AS stretch FROM an WINDOW o AS (PARTITION BY symbol ORDER BY bar ROWS UNBOUNDED PRECEDING)),
tu AS (SELECT *, sum(CASE WHEN up AND down THEN 1 ELSE 0 END) OVER (PARTITION BY symbol, stretch ORDER BY bar ROWS UNBOUNDED PRECEDING) AS turns FROM st),
tr AS (SELECT *, CAST(CASE WHEN anchor IS NOT NULL THEN CASE WHEN turns % 2 = 1 THEN -anchor ELSE anchor END WHEN turns = 0 THEN 0 WHEN turns % 2 = 1 THEN 1 ELSE -1 END AS INTEGER) AS trend FROM tu),
ev AS (SELECT *, CASE WHEN trend <> coalesce(lag(trend) OVER (PARTITION BY symbol ORDER BY bar), 0) THEN trend END AS event FROM tr)"""


def _recursive(value: str, weight: str, out: str) -> str:
    """An exponential mean as a recursion over row numbers."""
    return f"""WITH RECURSIVE {_HOURLY},
x AS (SELECT symbol, ts, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS i, {value} AS v FROM h),
r AS (SELECT symbol, i, CAST(v AS DOUBLE) AS y FROM x WHERE i = 1
  UNION ALL SELECT x.symbol, x.i, r.y + CAST({weight} AS DOUBLE) * (x.v - r.y) FROM r JOIN x ON x.symbol = r.symbol AND x.i = r.i + 1)
SELECT x.symbol, x.ts, round(r.y, 6) AS {out} FROM x JOIN r USING (symbol, i)"""


_RANGE = "greatest(high - low, abs(high - coalesce(lag(close) OVER (PARTITION BY symbol ORDER BY ts), high)), abs(low - coalesce(lag(close) OVER (PARTITION BY symbol ORDER BY ts), low)))"
_CONTRACT = "SELECT arg_max(event_type, ROW(ts, -event_id)) AS symbol FROM events"
_MULTISET = "publisher_id, instrument_id, symbol, ts_utc, open, high, low, close, volume"
_D = lambda c: f"CAST({_NUM[c]} AS DOUBLE)"


#: The series with the latest minute, of equal ones that of the first event in it.
_MINUTE_CONTRACT = "SELECT event_type FROM events x ORDER BY date_trunc('minute', x.ts) DESC, event_id LIMIT 1"


def oracle_sql() -> dict[str, str]:
    out = {f"bars_{k}": f"WITH {_bars('b', unit)} SELECT * FROM b" for k, unit in (("1m", "1 minute"), ("5m", "5 minutes"), ("1h", "1 hour"))}
    out["stream_bars_1h"] = out["bars_1h"]
    names = {1: "required", 2: "timestamps", 3: "symbols", 5: "duplicates", 6: "conflicts", 7: "prices", 8: "envelope", 9: "ticks", 10: "volume"}
    out |= {f"clean{n:02d}_{name}": _tagged(n) for n, name in names.items()}
    out["clean04_group_audit"] = f"""{_steps(4)},
w AS (SELECT *, epoch_us(ts_utc) - epoch_us(lag(ts_utc) OVER (PARTITION BY {_GROUP} ORDER BY ts_utc, src_row)) AS wait FROM s04)
SELECT {_GROUP}, count(*) AS row_count, min(ts_utc) AS first_ts_utc, max(ts_utc) AS last_ts_utc, count(*) FILTER (wait = 0) AS duplicate_timestamp_rows, count(*) FILTER (wait > 60000000) AS gap_count,
  CAST(coalesce(sum(CASE WHEN wait > 60000000 THEN wait // 60000000 - 1 END), 0) AS BIGINT) AS missing_minutes FROM w GROUP BY ALL"""
    out["clean05_symbol_conflicts"] = f"""{_steps(4)},
g AS (SELECT publisher_id, instrument_id, symbol, arg_min(src_row, ROW(ts_utc, src_row)) AS seen_at, count(*) AS n FROM s04 GROUP BY ALL),
f AS (SELECT *, first_value(symbol) OVER o AS first_symbol, first_value(seen_at) OVER o AS first_seen_row FROM g WINDOW o AS (PARTITION BY publisher_id, instrument_id ORDER BY symbol))
SELECT publisher_id, instrument_id, first_symbol, symbol AS conflicting_symbol, first_seen_row, seen_at AS conflicting_row, n AS conflicting_rows FROM f WHERE symbol <> first_symbol"""
    out["clean11_zero_volume"] = f"{_steps(11)}\nSELECT src_row, symbol, instrument_id, ts_utc, CAST(volume AS BIGINT) AS volume, zero_volume_flag FROM s11"
    out["clean12_large_moves"] = f"""{_steps(11)},
n AS (SELECT *, TRY_CAST(close AS DECIMAL(20,8)) AS now FROM s11),
l AS (SELECT *, lag(now) OVER o AS previous_close, lag(ts_utc) OVER o AS previous_ts_utc FROM n WINDOW o AS (PARTITION BY {_GROUP} ORDER BY ts_utc, src_row))
SELECT src_row, symbol, instrument_id, previous_ts_utc, CAST(previous_close AS DOUBLE) AS previous_close, round((CAST(now AS DOUBLE) - CAST(previous_close AS DOUBLE)) / CAST(previous_close AS DOUBLE) * 100, 6) AS close_return_pct,
  (epoch_us(ts_utc) - epoch_us(previous_ts_utc)) // 60000000 AS minutes_since_previous, CASE WHEN now > previous_close THEN 'LARGE_UP' ELSE 'LARGE_DOWN' END AS anomaly_direction
FROM l WHERE abs(now - previous_close) * 100 >= previous_close"""
    out["reject_summary"] = _steps(11) + "\n" + " UNION ALL ".join(f"SELECT {n} AS step, reason AS reject_reason, count(*) AS n_rows FROM t{n:02d} WHERE reason IS NOT NULL GROUP BY ALL" for n in range(1, 12))
    out["pipeline_clean_all"] = f"{_steps(12)}\nSELECT src_row, ts_utc, rtype, publisher_id, instrument_id, {', '.join(f'{_D(c)} AS {c}' for c in _PRICES)}, CAST(volume AS BIGINT) AS volume, symbol, zero_volume_flag FROM s12"
    out["rollup_clean"] = f"""{_steps(11)}
SELECT {_GROUP}, time_bucket(INTERVAL '5 minutes', s.ts_utc) AS ts_utc, arg_min({_D("open")}, ROW(s.ts_utc, src_row)) AS open, max({_D("high")}) AS high, min({_D("low")}) AS low, arg_max({_D("close")}, ROW(s.ts_utc, src_row)) AS close,
  CAST(sum(CAST(volume AS BIGINT)) AS BIGINT) AS volume, arg_min(src_row, ROW(s.ts_utc, src_row)) AS src_row, arg_min(rtype, ROW(s.ts_utc, src_row)) AS rtype, arg_min(zero_volume_flag, ROW(s.ts_utc, src_row)) AS zero_volume_flag FROM s11 s GROUP BY {_GROUP}, time_bucket(INTERVAL '5 minutes', s.ts_utc)"""
    out["latest_contract"] = _CONTRACT
    out["last_n_bars"] = f"WITH {_HOURLY} SELECT * FROM h WHERE symbol = ({_CONTRACT}) ORDER BY ts DESC LIMIT 240"
    out["dedup_last"] = "SELECT event_type AS symbol, date_trunc('minute', ts) AS ts, max(event_id) AS src_row, CAST(arg_max(CAST(value AS DECIMAL(18,2)), event_id) AS DOUBLE) AS close FROM events e GROUP BY event_type, date_trunc('minute', e.ts)"
    out["range_filter"] = f"WITH {_HOURLY} SELECT * FROM h WHERE low <= least(open, close) AND greatest(open, close) <= high AND ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-10 12:00:00'"
    for name, strict in (("pivots_strict", True), ("pivots_half_strict", False)):
        out[name] = f"WITH {_pivots(strict)} SELECT symbol, ts, pivot_kind, pivot_price FROM pv WHERE pivot_kind IS NOT NULL"
    out["zigzag"] = f"WITH {_kept(True)} SELECT symbol, ts, pivot_kind, pivot_price FROM z"
    out["hhll_flags"] = f"{_FLAGS} SELECT * FROM f"
    out["hhll_counts"] = f'{_FLAGS} SELECT symbol, CAST(sum("Higher_Low") AS BIGINT) AS higher_low, CAST(sum("Higher_High") AS BIGINT) AS higher_high, CAST(sum("Lower_Low") AS BIGINT) AS lower_low, CAST(sum("Lower_High") AS BIGINT) AS lower_high FROM f GROUP BY symbol'
    out["structure_labels"] = f"WITH {_kept(False)} SELECT symbol, ts, pivot_kind, pivot_price, pivot_label, confirmed_at FROM lab"
    out["structure_levels"] = f"{_TREND} SELECT symbol, ts, support, resistance, trend FROM tr"
    out["break_events"] = f"{_TREND} SELECT symbol, ts, event, CASE event WHEN 1 THEN resistance ELSE support END AS event_level FROM ev WHERE event IS NOT NULL"
    out["trend_now"] = f"""{_TREND},
last_bar AS (SELECT * FROM tr QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY bar DESC) = 1),
recent AS (SELECT symbol, pivot_label FROM lab QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) <= 4),
guess AS (SELECT symbol, bool_or(pivot_label IN ('HH', 'HL')) AS up, bool_or(pivot_label IN ('LH', 'LL')) AS down FROM recent GROUP BY symbol),
n AS (SELECT symbol, count(*) AS n_pivots FROM lab GROUP BY symbol)
SELECT b.symbol, CAST(CASE WHEN trend <> 0 THEN trend WHEN coalesce(n_pivots, 0) < 2 THEN 0 WHEN guess.up THEN 1 WHEN guess.down THEN -1 ELSE 0 END AS INTEGER) AS trend, support, resistance, coalesce(n_pivots, 0) AS n_pivots FROM last_bar b LEFT JOIN guess USING (symbol) LEFT JOIN n USING (symbol)"""
    same = {"pieces_flags": "hhll_flags", "pieces_labels": "structure_labels", "pieces_levels": "structure_levels", "pieces_events": "break_events", "pieces_trend_now": "trend_now"}
    out |= {name: out[other] for name, other in same.items()}
    out["multiset_compare"] = f"""{_steps(6)},
a AS (SELECT {_MULTISET}, count(*) AS n FROM s04 GROUP BY ALL), b AS (SELECT {_MULTISET}, count(*) AS n FROM s06 GROUP BY ALL),
j AS (SELECT coalesce(a.n, 0) AS x, coalesce(b.n, 0) AS y FROM a FULL JOIN b USING ({_MULTISET}))
SELECT CAST(sum(x) AS BIGINT) AS total_left, CAST(sum(y) AS BIGINT) AS total_right, CAST(sum(least(x, y)) AS BIGINT) AS common, CAST(sum(greatest(x - y, 0)) AS BIGINT) AS left_only, CAST(sum(greatest(y - x, 0)) AS BIGINT) AS right_only FROM j"""
    out["bar_features"] = f"""WITH {_HOURLY},
m AS (SELECT *, (high + low) * 0.5::DOUBLE AS midpoint, (open + high + low + close) * 0.25::DOUBLE AS ohlc4, {_RANGE} AS true_range, avg(CAST(volume AS DOUBLE)) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS volume_mean FROM h),
v AS (SELECT *, midpoint - coalesce(lag(midpoint) OVER o, midpoint) AS v_midpoint, ohlc4 - coalesce(lag(ohlc4) OVER o, ohlc4) AS v_ohlc4, 2.0::DOUBLE * (close - midpoint) AS v_clv FROM m WINDOW o AS (PARTITION BY symbol ORDER BY ts))
SELECT symbol, ts, round(midpoint, 6) AS midpoint, round(ohlc4, 6) AS ohlc4, round(v_midpoint, 6) AS v_midpoint, round(v_ohlc4, 6) AS v_ohlc4, round(v_clv, 6) AS v_clv, round(0.5::DOUBLE * (v_midpoint + v_clv), 6) AS v_blend,
  round(true_range, 6) AS true_range, round(volume_mean, 6) AS volume_mean, round(greatest(ln(1 + volume / greatest(volume_mean, 1.0::DOUBLE)) / ln(2.0::DOUBLE), 0.1::DOUBLE), 6) AS volume_mass FROM v"""
    out["multiset_digests"] = out["multiset_compare"]
    units = lambda c: f"CAST(split_part({c}, '.', 1) || rpad(split_part({c}, '.', 2), 16, '0') AS HUGEINT)"
    off = " OR ".join(f"least({c} % 2500000000000000, 2500000000000000 - {c} % 2500000000000000) >= 2500000000" for c in "ohlc")
    around = (("", ""), ("", "0000000000"), ("", "0000001"), ("", "00005"), ("1000000000", ""), ("1000000000", "1"), ("", "000025"), ("", "00002499999999"))
    text = " ".join(f"WHEN {k} THEN '{before}' || p || '{after}'" for k, (before, after) in enumerate(around))
    out["clean_long_prices"] = f"""WITH e AS (SELECT event_id, CAST(CAST(100 + round(CAST(value AS DECIMAL(18,2)) * 4) / 4 AS DECIMAL(18,2)) AS VARCHAR) AS p FROM events),
t AS (SELECT event_id, CASE event_id % 8 {text} END AS x FROM e),
u AS (SELECT event_id, {units("x")} AS o, {units("x")} AS c, CASE WHEN event_id % 3 = 0 THEN {units("'9' || x")} ELSE {units("x")} END AS h,
  CASE WHEN event_id % 7 = 0 THEN {units("'9' || x")} WHEN event_id % 11 = 0 THEN 0::HUGEINT ELSE {units("x")} END AS l FROM t)
SELECT event_id, CASE WHEN l = 0 THEN 'NON_POSITIVE_PRICE' ELSE 'KEPT' END AS price, CASE WHEN l > 0 AND NOT (l <= least(o, c) AND greatest(o, c) <= h) THEN 'INVALID_OHLC' ELSE 'KEPT' END AS envelope,
  CASE WHEN l > 0 AND ({off}) THEN 'INVALID_TICK_SIZE' ELSE 'KEPT' END AS tick FROM u"""
    out["read_series"] = f"""WITH m AS (
  SELECT event_type AS symbol, date_trunc('minute', ts) AS ts, max(event_id) AS src_row, CAST(arg_max(CAST(value AS DECIMAL(18,2)), event_id) AS DOUBLE) AS close, 1.0::DOUBLE AS volume
  FROM events e WHERE event_type = ({_MINUTE_CONTRACT}) GROUP BY ALL)
SELECT * FROM m WHERE ts BETWEEN TIMESTAMP '2024-01-03 00:00:00' AND TIMESTAMP '2024-01-28 12:00:00' ORDER BY ts DESC LIMIT 1000"""
    out["pieces_features"] = out["bar_features"]
    out["ema_200"] = _recursive("close", "2.0 / 201", "ema_200").replace("CAST(2.0 / 201 AS DOUBLE)", "(2.0::DOUBLE / 201)")
    out["atr_14"] = _recursive(_RANGE, "1.0 / 14", "atr_14").replace("CAST(1.0 / 14 AS DOUBLE)", "(1.0::DOUBLE / 14)")
    return out
