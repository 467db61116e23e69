"""The twelve cleaning steps. Each maps a table to kept and rejected rows, and to audits where it has some.

The functions step01_... to step12_... do one step on any table. run_steps() chains them in one plan: each
field is parsed once, reasons are columns of that, and a row carries the first step that rejects it, so no
step repeats the work of those before it and one scan knows the rejects of all. Order of rows is that of
(ts, src_row); tables carry src_row, as Spark keeps no order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import GROUP, OHLCV, PRICES, CleanConfig
from ..functions import predicates as P
from ..sources.stored import stored


@dataclass
class StepResult:
    """``tagged`` has the step's input rows with reject_reason, null for a kept one.

    ``adds`` are columns that kept rows get; one of ``instead`` takes the place of another column.
    """

    tagged: DataFrame
    adds: dict[str, Column] = field(default_factory=dict)
    instead: dict[str, str] = field(default_factory=dict)
    audits: dict[str, DataFrame] = field(default_factory=dict)

    @property
    def kept(self) -> DataFrame:
        rows = self.tagged.where("reject_reason is null")
        places = [self.adds[self.instead[c]].alias(self.instead[c]) if c in self.instead else F.col(f"`{c}`") for c in rows.columns if c != "reject_reason"]
        return rows.select(*places, *(v.alias(k) for k, v in self.adds.items() if k not in self.instead.values()))

    @property
    def rejects(self) -> DataFrame:
        return self.tagged.where("reject_reason is not null")

    @property
    def both(self) -> DataFrame:
        """Kept and rejected rows of one pass: the input's columns, those that kept rows get (null in rejects), reject_reason."""
        return self.tagged.withColumns({k: F.when(F.col("reject_reason").isNull(), v) for k, v in self.adds.items()})


def _tag(df: DataFrame, reason: Column) -> DataFrame:
    return df.withColumn("reject_reason", reason)


def _fail_where(df: DataFrame, bad: Column, message: str) -> DataFrame:
    return df.where(F.when(bad, F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True)))


def step01_required(df: DataFrame, config: CleanConfig) -> StepResult:
    """Rows with a blank required field are dropped."""
    if missing := [c for c in config.required if c not in df.columns]:
        raise ValueError(f"missing columns: {missing}")
    return StepResult(_tag(df, F.when(P.any_of([P.is_blank(F.col(c)) for c in config.required]), "MISSING_REQUIRED_FIELD")))


def step02_timestamps(df: DataFrame, config: CleanConfig) -> StepResult:
    """ts_event becomes ts_utc, in its place; rejects keep ts_event."""
    return StepResult(_tag(df, P.stamp_reason(F.col("ts_event"), config)), {"ts_utc": P.stamp(F.col("ts_event"))}, {"ts_event": "ts_utc"})


def step03_symbols(df: DataFrame, config: CleanConfig) -> StepResult:
    fields = [F.col(c) for c in ("instrument_class", "security_type") if c in df.columns]
    return StepResult(_tag(df, P.symbol_reason(F.col("symbol"), fields, config)))


def _span(span: str) -> Column:
    return F.date_trunc(span, "ts_utc").cast("timestamp_ntz")


def group_audit(df: DataFrame, group: tuple[str, ...] = GROUP, span: str = "day") -> DataFrame:
    """Rows, first and last time, repeated times, gaps and missing minutes of each series.

    Each span of a series (a day) is summed up by itself, as a first and a last time and counts; two such sums
    in a row are one again, with the gap between them. So a task has one span's rows, or a row a span.
    """
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    gap = lambda wait: (wait > 60_000_000).cast("long")
    missing = lambda wait: F.when(wait > 60_000_000, F.floor(wait / 60_000_000) - 1).otherwise(0)
    rows = df.select(*group, "ts_utc", "src_row", _span(span).alias("_span"))
    before = F.lag("ts_utc").over(W.partitionBy("_span", *group).orderBy("ts_utc", "src_row"))
    rows = rows.withColumn("wait", micros(F.col("ts_utc")) - micros(before))
    wait = F.col("wait")
    sums = rows.groupBy("_span", *group).agg(
        F.count("*").alias("n"), F.min("ts_utc").alias("first"), F.max("ts_utc").alias("last"), F.count_if(wait == 0).alias("same"),
        F.coalesce(F.sum(gap(wait)), F.lit(0)).alias("gaps"), F.coalesce(F.sum(missing(wait)), F.lit(0)).alias("missing"),
    )
    between = micros(F.col("first")) - micros(F.lag("last").over(W.partitionBy(*group).orderBy("_span")))
    sums = sums.withColumn("wait", between)
    return sums.groupBy(*group).agg(
        F.sum("n").alias("row_count"), F.min("first").alias("first_ts_utc"), F.max("last").alias("last_ts_utc"), F.sum("same").alias("duplicate_timestamp_rows"),
        F.sum(F.col("gaps") + F.coalesce(gap(wait), F.lit(0))).alias("gap_count"), F.sum(F.col("missing") + F.coalesce(missing(wait), F.lit(0))).alias("missing_minutes"),
    )


def step04_order_and_gaps(df: DataFrame, config: CleanConfig) -> StepResult:
    """Nothing goes; the audit says how complete each series is. A blank key or time fails the job."""
    df = _fail_where(df, P.any_of([*(P.is_blank(F.col(c)) for c in config.group), F.col("ts_utc").isNull()]), "a series key or time is blank")
    return StepResult(_tag(df, F.lit(None).cast("string")), audits={"groups": group_audit(df, config.group)})


def symbol_conflicts(df: DataFrame) -> DataFrame:
    """Instruments with several symbols: each symbol but the smallest, and where both were seen first."""
    seen = df.groupBy("publisher_id", "instrument_id", "symbol").agg(F.min(F.struct("ts_utc", "src_row")).alias("at"), F.count("*").alias("n"))
    own = W.partitionBy("publisher_id", "instrument_id").orderBy("symbol")
    return (
        seen.withColumn("first_symbol", F.first("symbol").over(own)).withColumn("first_seen_row", F.first("at").over(own)["src_row"]).where("symbol <> first_symbol")
        .select("publisher_id", "instrument_id", "first_symbol", F.col("symbol").alias("conflicting_symbol"), "first_seen_row", F.col("at.src_row").alias("conflicting_row"), F.col("n").alias("conflicting_rows"))
    )


def step05_exact_duplicates(df: DataFrame, config: CleanConfig) -> StepResult:
    """Of rows with the same series, time and OHLCV text the first stays."""
    again = F.row_number().over(W.partitionBy(*config.group, "ts_utc", *OHLCV).orderBy("src_row")) > 1
    return StepResult(_tag(df, F.when(again, "EXACT_DUPLICATE")), audits={"symbols": symbol_conflicts(df)})


def step06_conflicts(df: DataFrame, config: CleanConfig) -> StepResult:
    """All rows of an instrument's minute go if their OHLCV texts differ; rows with a null key stay."""
    key = ("publisher_id", "instrument_id", "ts_utc")
    minute = W.partitionBy(*key)
    differ = P.any_of([F.min(c).over(minute) != F.max(c).over(minute) for c in OHLCV])
    whole = ~P.any_of([F.col(c).isNull() for c in key])
    return StepResult(_tag(df, F.when(whole & F.coalesce(differ, F.lit(False)), "CONFLICT_DUPLICATE")))


def step07_prices(df: DataFrame, config: CleanConfig) -> StepResult:
    return StepResult(_tag(df, P.price_reason()))


def step08_envelope(df: DataFrame, config: CleanConfig) -> StepResult:
    return StepResult(_tag(df, P.envelope_reason()))


def step09_ticks(df: DataFrame, config: CleanConfig) -> StepResult:
    return StepResult(_tag(df, P.tick_reason(config)))


def step10_volume(df: DataFrame, config: CleanConfig) -> StepResult:
    return StepResult(_tag(df, P.volume_reason()))


def step11_zero_volume(df: DataFrame, config: CleanConfig) -> StepResult:
    """zero_volume_flag is added; a volume that isn't a whole number fails the job."""
    if "zero_volume_flag" in df.columns:
        raise ValueError("zero_volume_flag exists already")
    reason = P.volume_reason()
    df = _fail_where(df, reason.isin("INVALID_VOLUME", "NON_INTEGER_VOLUME"), "a volume isn't a whole number")
    return StepResult(_tag(df, F.when(reason == "NEGATIVE_VOLUME", reason)), {"zero_volume_flag": zero_volume()})


def zero_volume() -> Column:
    return F.coalesce(P.number(F.col("volume"), P.WHOLE) == 0, F.lit(False)).cast("int")


def after_previous(df: DataFrame, values: dict[str, str], group: tuple[str, ...], span: str = "day") -> DataFrame:
    """df with columns of the row before in its series, by (ts_utc, src_row): ``values`` are their names and what they are of.

    Rows meet in spans of a series (a day). The first row of a span finds its predecessor among the first and
    last rows of all spans, which are a small table.
    """
    own, along = W.partitionBy("_span", *group).orderBy("ts_utc", "src_row"), W.partitionBy(*group).orderBy("ts_utc", "src_row")
    lags = lambda order: {name: F.lag(c).over(order) for name, c in values.items()}
    rows = df.withColumn("_span", _span(span))
    rows = rows.withColumns({"_first": F.row_number().over(own) == 1, "_last": F.lead(F.lit(True)).over(own).isNull(), **lags(own)})
    edges = rows.where("_first or _last").withColumns(lags(along)).where("_first")
    return rows.where("not _first").unionByName(edges).drop("_span", "_first", "_last")


def large_moves(df: DataFrame, config: CleanConfig) -> DataFrame:
    """Rows whose close moved by move_pct or more against the series' row before."""
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    rows = after_previous(df.withColumn("now", P.number(F.col("close"))), {"previous_close": "now", "previous_ts_utc": "ts_utc"}, config.group)
    limit = F.lit(config.move_pct).cast("decimal(10,4)")
    change = (F.col("now").cast("double") - F.col("previous_close").cast("double")) / F.col("previous_close").cast("double") * 100
    return (
        rows.where((F.col("previous_close") > 0) & (F.abs(F.col("now") - F.col("previous_close")) * 100 >= limit * F.col("previous_close")))
        .withColumns({
            "close_return_pct": change, "minutes_since_previous": F.floor((micros("ts_utc") - micros("previous_ts_utc")) / 60_000_000),
            "anomaly_direction": F.when(F.col("now") > F.col("previous_close"), "LARGE_UP").otherwise("LARGE_DOWN"),
        }).drop("now")
    )


def step12_large_moves(df: DataFrame, config: CleanConfig) -> StepResult:
    """Nothing goes; large moves are an audit."""
    return StepResult(_tag(df, F.lit(None).cast("string")), audits={"large_moves": large_moves(df, config)})


STEPS = (
    step01_required, step02_timestamps, step03_symbols, step04_order_and_gaps, step05_exact_duplicates, step06_conflicts,
    step07_prices, step08_envelope, step09_ticks, step10_volume, step11_zero_volume, step12_large_moves,
)


#: Every reason to reject a row, with the step that gives it.
REASONS = (
    (1, "MISSING_REQUIRED_FIELD"), (2, "INVALID_TIMESTAMP"), (2, "TIMESTAMP_OUT_OF_RANGE"), (2, "TIMESTAMP_NOT_MINUTE_ALIGNED"),
    (3, "INVALID_SYMBOL"), (3, "OPTION_INSTRUMENT"), (3, "FUTURES_SPREAD"), (3, "INVALID_PRODUCT"), (5, "EXACT_DUPLICATE"), (6, "CONFLICT_DUPLICATE"),
    (7, "INVALID_PRICE"), (7, "NON_FINITE_PRICE"), (7, "NON_POSITIVE_PRICE"), (8, "INVALID_OHLC"), (9, "INVALID_TICK_SIZE"),
    (10, "INVALID_VOLUME"), (10, "NEGATIVE_VOLUME"), (10, "NON_INTEGER_VOLUME"),
)


class Steps(Sequence):
    """The StepResults of a chain, all of the one plan ``whole`` (see tagged_once()); each is built when it is asked for.

    A row that failed_step names is in the input of the steps up to that one, any other in that of all steps.
    """

    def __init__(self, whole: DataFrame, names: list[str], config: CleanConfig, last: int):
        self.whole, self.names, self.config, self.last = whole, names, config, last
        self._made: dict[int, StepResult] = {}

    def __len__(self) -> int:
        return self.last

    def __getitem__(self, at):
        if isinstance(at, slice):
            return [self[i] for i in range(*at.indices(self.last))]
        step = range(1, self.last + 1)[at]
        if step not in self._made:
            self._made[step] = self._result(step)
        return self._made[step]

    def _result(self, step: int) -> StepResult:
        failed = F.col("failed_step")
        names = [c if step <= 2 or c != "ts_event" else "ts_utc" for c in self.names]
        reason = F.when(failed == step, F.col("reject_reason")).alias("reject_reason")
        rows = self.whole.where(failed.isNull() | (failed >= step)).select(*(F.col(f"`{c}`") for c in names), *(["ts_utc"] if step == 2 else []), reason)
        if step == 2:
            return _Stamped(rows, {"ts_utc": F.col("ts_utc")}, {"ts_event": "ts_utc"})
        if step == 11:
            return StepResult(rows, {"zero_volume_flag": zero_volume()})
        if step == 12:
            rows = rows.withColumn("zero_volume_flag", zero_volume())
        group = self.config.group
        audit = {4: ("groups", group_audit, group), 5: ("symbols", symbol_conflicts), 12: ("large_moves", large_moves, self.config)}.get(step)
        if audit is None:
            return StepResult(rows)
        name, make, *more = audit
        return StepResult(rows, audits={name: make(rows.drop("reject_reason"), *more)})


def _apart(df: DataFrame, without: tuple[str, ...] = (), **columns: Column) -> DataFrame:
    """df with further columns, behind an explode, so that filters on them don't repeat their expressions."""
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns if c not in without), *(v.alias(k) for k, v in columns.items()))
    return df.select(F.explode(F.array(row)).alias("_row")).select("_row.*")


_REASONS = ("r1", "r2", "r3", "r7", "r8", "r9", "r10", "_no_key")


def _early_reasons(raw: DataFrame, config: CleanConfig) -> DataFrame:
    """raw with ts_utc, and the reasons r1, r2, r3 of the steps before rows are compared, and _no_key.

    In layers (as are the late ones), as the JVM runs a generated method of over 8,000 bytes without compiling it.
    """
    if missing := [c for c in config.required if c not in raw.columns]:
        raise ValueError(f"missing columns: {missing}")
    if clash := {"ts_utc", "zero_volume_flag", "failed_step", "reject_reason", "_live", "_deal", *_REASONS} & set(raw.columns):
        raise ValueError(f"columns {sorted(clash)} exist already")
    texts = _apart(
        raw, ts_utc=P.stamp(F.col("ts_event")), _fraction=P.past_micros(F.col("ts_event")), _symbol=F.upper(P.stripped(F.col("symbol"))),
        _blank=P.any_of([P.is_blank(F.col(c)) for c in config.required]), _no_key=P.any_of([P.is_blank(F.col(c)) for c in config.group]),
    )
    fields = [F.col(c) for c in ("instrument_class", "security_type") if c in raw.columns]
    return _apart(
        texts, ("_fraction", "_symbol", "_blank"), r1=F.when(F.col("_blank"), "MISSING_REQUIRED_FIELD"), r2=P.moment_reason(F.col("ts_utc"), F.col("_fraction"), config),
        r3=P.symbol_reason(F.col("_symbol"), fields, config),
    )


def price_reasons(rows: DataFrame, config: CleanConfig, keep: Sequence[str] | None = None) -> DataFrame:
    """rows (all columns, or those to keep) with the reasons r7, r8 and r9 of the price steps, each of all rows.

    In layers, as the JVM runs a generated method of over 8,000 bytes without compiling it: whole-stage code would have
    all of them in one method, so a lambda, which has no such code, is in each. _apart() keeps filters from repeating
    the layers; an explode of lambdas would only be interpreted, so it has no work to do.
    """
    digits, decimals = {c: f"_{c}_digits" for c in PRICES}, {c: f"_{c}_decimal" for c in PRICES}
    if clash := {*digits.values(), *decimals.values(), "_long", "_long_ok", "r7", "r8", "r9"} & set(rows.columns):
        raise ValueError(f"columns {sorted(clash)} exist already")
    numbers, prices, long = [F.col(v) for v in digits.values()], {c: F.col(v) for c, v in decimals.items()}, F.col("_long")
    apart = lambda v: P.through(v, [lambda x: x])
    cut, beyond, off = P.off_grid(config)
    out = rows.withColumns({"r7": P.price_reason(), "_long": ~P.simple()})
    is_long = F.col("r7").isNull() & long
    out = out.withColumns({**{v: P.inline(F.when(is_long, F.col(c)), P.SCIENTIFIC) for c, v in digits.items()}, "_long": apart(is_long)})
    out = out.withColumns({
        **{v: P.inline(F.col(v), (cut, beyond)) for v in digits.values()}, **{v: F.when(~long, P.number(F.col(c))) for c, v in decimals.items()},
        "_long_ok": F.when(long, P.envelope_ok(*numbers)), "_long": apart(long),
    })
    off_grid = F.when(apart(long), P.any_of([off(n) for n in numbers]))
    out = out.withColumns({"r8": P.envelope_reason(prices, F.col("_long_ok")), "r9": P.tick_reason(config, prices, off_grid)})
    return _apart(out.select(*(F.col(f"`{c}`") for c in keep or rows.columns), "r7", "r8", "r9"))


def _late_reasons(rows: DataFrame, config: CleanConfig) -> DataFrame:
    """rows with the reasons r7, r8, r9 and r10 of the steps after rows were compared."""
    return _apart(price_reasons(rows, config), r10=P.volume_reason())


def _fails(df: DataFrame, reasons: dict[int, Column]) -> DataFrame:
    """A row that no step has rejected yet gets the first of these steps' reasons."""
    step = F.coalesce(*(F.when(r.isNotNull(), i) for i, r in reasons.items()))
    return df.withColumns({"failed_step": F.coalesce("failed_step", step), "reject_reason": F.coalesce("reject_reason", *reasons.values())})


_MINUTE = ("publisher_id", "instrument_id", "ts_utc")


def _compared(rows: DataFrame, config: CleanConfig, last: int) -> DataFrame:
    """rows after steps 5 and 6, by windows over an instrument's minute; a minute's rows are in one task.

    Those that are rejected already, whose keys may all be alike (no time), are dealt evenly beside them.
    """
    live = F.col("failed_step").isNull()
    deal = F.when(live, F.lit(0).cast("long")).otherwise(F.xxhash64("src_row"))
    rows = rows.withColumns({"_live": live, "_deal": deal}).repartition("_deal", *_MINUTE)
    again = F.row_number().over(W.partitionBy("_deal", "_live", *_MINUTE, *(c for c in config.group if c not in _MINUTE), *OHLCV).orderBy("src_row")) > 1
    rows = _fails(rows, {5: F.when(again, "EXACT_DUPLICATE")})
    if last >= 6:
        own = W.partitionBy("_deal", "_live", *_MINUTE)
        differ = P.any_of([F.min(c).over(own) != F.max(c).over(own) for c in OHLCV])
        rows = _fails(rows.withColumn("_live", live), {6: F.when(F.coalesce(differ, F.lit(False)), "CONFLICT_DUPLICATE")})
    return rows.drop("_live", "_deal")


def _compared_by_sums(rows: DataFrame, config: CleanConfig, last: int) -> DataFrame:
    """_compared() of rows that no step has rejected, by sums that combine before a shuffle; the joins back may split a minute.

    Copies have the texts of the row that stays, so a minute's least and greatest texts are those of all its rows.
    """
    copy, minute = F.struct(*config.group, "ts_utc", *OHLCV), F.struct(*_MINUTE)
    first = rows.groupBy(copy.alias("_copy")).agg(F.min("src_row").alias("_first"))
    rows = rows.withColumn("_row", copy).join(first, F.col("_row") == F.col("_copy"))
    rows = _fails(rows, {5: F.when(F.col("src_row") != F.col("_first"), "EXACT_DUPLICATE")}).drop("_row", "_copy", "_first")
    if last < 6:
        return rows
    differ = F.coalesce(P.any_of([F.min(c) != F.max(c) for c in OHLCV]), F.lit(False))
    minutes = rows.groupBy(minute.alias("_minute")).agg(differ.alias("_differ"))
    rows = rows.withColumn("_row", minute).join(minutes, F.col("_row") == F.col("_minute"))
    return _fails(rows, {6: F.when(F.col("_differ"), "CONFLICT_DUPLICATE")}).drop("_row", "_minute", "_differ")


def hot_minutes(rows: DataFrame, most: int) -> DataFrame:
    """(_hot_minute): an instrument's minutes with over ``most`` rows that no step has rejected; written, as it is small."""
    sizes = rows.where("failed_step is null").groupBy(F.struct(*_MINUTE).alias("_hot_minute")).agg(F.count("*").alias("n"))
    return stored(sizes.where(F.col("n") > most).select("_hot_minute"), "hot_minutes")


def tagged_once(raw: DataFrame, config: CleanConfig, last: int = 12, hot: int | None = None) -> DataFrame:
    """raw with ts_utc, and failed_step and reject_reason of the first of the steps 1 to ``last`` that rejects a row.

    Rows go to their instrument's minute once, which serves the windows of both steps that compare rows. ``hot``:
    minutes of over so many rows are found in a pass of its own and compared by sums, so no task has one whole.
    """
    rows = _early_reasons(raw, config)
    own_row = lambda first, to: {i: F.col(f"r{i}") for i in range(first, min(last, to) + 1)}
    rows = _fails(rows.withColumns({"failed_step": F.lit(None).cast("int"), "reject_reason": F.lit(None).cast("string")}), own_row(1, 3))
    if last >= 4:
        rows = _fail_where(rows, F.col("failed_step").isNull() & (F.col("_no_key") | F.col("ts_utc").isNull()), "a series key or time is blank")
    if last >= 5:
        busy = None if hot is None else hot_minutes(rows, hot)
        if busy is None or busy.isEmpty():
            rows = _compared(rows, config, last)
        else:
            rows = rows.join(busy, F.col("failed_step").isNull() & (F.struct(*_MINUTE) == F.col("_hot_minute")), "left")
            split = F.col("_hot_minute").isNotNull()
            calm, busy = (rows.where(x).drop("_hot_minute") for x in (~split, split))
            rows = _compared(calm, config, last).unionByName(_compared_by_sums(busy, config, last))
    if last >= 7:
        rows = _fails(_late_reasons(rows, config), own_row(7, 10))
    return rows.drop(*_REASONS)


def run_steps(raw: DataFrame, config: CleanConfig | None = None, last: int = 12, hot: int | None = None) -> Steps:
    """Results of the steps 1 to ``last``, each on what the one before kept; nothing runs until an action (but for ``hot``, see tagged_once())."""
    config = config or CleanConfig()
    return Steps(tagged_once(raw, config, last, hot), raw.columns, config, last)


class _Stamped(StepResult):
    """Step 2 of a chain, whose tagged rows have ts_utc beside ts_event."""

    @property
    def kept(self) -> DataFrame:
        names = ["ts_utc" if c == "ts_event" else c for c in self.tagged.columns if c not in ("ts_utc", "reject_reason")]
        return self.tagged.where("reject_reason is null").select(*names)

    @property
    def rejects(self) -> DataFrame:
        return self.tagged.where("reject_reason is not null").drop("ts_utc")


def all_rejects(results: Steps) -> DataFrame:
    """(step, src_row, reject_reason) of what all steps rejected."""
    return results.whole.where("failed_step is not null").select(F.col("failed_step").alias("step"), "src_row", "reject_reason")


def typed(clean: DataFrame) -> DataFrame:
    """A clean table with decimal prices and a whole volume."""
    return clean.withColumns({**{c: P.number(F.col(c)) for c in PRICES}, "volume": P.number(F.col("volume"), P.WHOLE).cast("long")})
