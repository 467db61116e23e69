"""Long series: market structure over pieces of a series that are worked on at once.

The functions of structure.py give each series to one task. Here a series is cut into pieces of a fixed
number of bars. A piece sees the bars that its pivots need on either side of it, and everything else that
it needs of the bars before is a state. What a piece does to a state is summed up in one row:

* zigzag: its first and its last leg (kind, best price, bar), between which all is settled within it;
* levels: its last pivot of each kind, and those in its last bars, which only later bars confirm;
* trend: the last one-sided break, if any, and the number of two-sided ones since. Such a row is a function
  from trend to trend, and two in a row are again one.

A window over those rows, one or two a piece, composes them, and each piece gets the state that it starts
with by a join. So of a series of n bars no task holds more than max(a piece, 2 n / rows) rows.

The bars are read three times: to count them, for pivots, and for all columns up to levels and breaks, which
are written to the shared folder (as are counts, pivots and states). The result reads that table; all that is
left to add, the trend, is a function of a row and its piece's state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F

from ..config import PivotConfig
from ..functions import indicators
from ..sources.stored import stored

#: Bars of a piece.
ROWS = 1 << 16
_KINDS = ("high", "low")
_OWN = ("_series", "_span", "_piece")


def spans(order: str, span: str) -> Column:
    """The span of time that a row is in; rows without a time are in the first."""
    return F.coalesce(F.date_trunc(span, order).cast("timestamp_ntz"), F.lit("0001-01-01 00:00:00").cast("timestamp_ntz"))


def span_counts(df: DataFrame, group: tuple[str, ...], order: str, span: str) -> DataFrame:
    """(_series, _span, n, before): rows of each span of each series, and of the series' spans before it."""
    counts = df.groupBy(F.struct(*group).alias("_series"), spans(order, span).alias("_span")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("_series").orderBy("_span").rowsBetween(W.unboundedPreceding, -1))
    return counts.withColumn("before", F.coalesce(before, F.lit(0)))


def numbered(df: DataFrame, group: tuple[str, ...] = ("symbol",), order: str = "ts", span: str = "month", counts: DataFrame | None = None) -> DataFrame:
    """df with _series, a struct of its key (nulls are a key), and bar, the row's number in its series from 0.

    Rows are counted within spans of time, which are added up; a task holds the rows of one span of a series.
    """
    counts = span_counts(df, group, order, span) if counts is None else counts
    rows = df.withColumns({"_series": F.struct(*group), "_span": spans(order, span)})
    rows = rows.withColumn("bar", F.row_number().over(W.partitionBy("_span", "_series").orderBy(order)))
    return rows.join(counts.select("_series", "_span", "before"), ["_series", "_span"]).withColumn("bar", F.col("before") + F.col("bar") - 1).drop("before", "_span")


def overlapping(rows: DataFrame, size: int, left: int = 0, right: int = 0) -> DataFrame:
    """numbered() rows with _piece: a bar is in its own piece, and in that of the bar ``left`` after or ``right`` before it."""
    piece, bar = (lambda at: F.floor(at / size)), F.col("bar")
    return rows.withColumn("_piece", F.explode(F.array_distinct(F.array(piece(bar), piece(bar + left), F.greatest(piece(bar - right), F.lit(0))))))


def owned(rows: DataFrame, size: int) -> DataFrame:
    """overlapping() rows without those that are in a piece as a neighbour only."""
    return rows.where(F.col("_piece") == F.floor(F.col("bar") / size))


def features(bars: DataFrame, group: tuple[str, ...] = ("symbol",), order: str = "ts", rows: int = ROWS, span: str = "month") -> DataFrame:
    """indicators.features() piece by piece: a bar needs the 19 before it at most."""
    if rows < 20:
        raise ValueError("a piece has 20 bars or more")
    near = overlapping(numbered(bars, group, order, span), rows, left=20)
    return owned(indicators.features(near, ("_piece", "_series"), "bar"), rows).drop("_piece", "_series", "bar")


class Pieces:
    """The passes over one table of bars; result() has them all."""

    def __init__(self, bars: DataFrame, config: PivotConfig, group: tuple[str, ...], order: str, rows: int, span: str):
        if rows <= max(config.left, config.right):
            raise ValueError("a piece has more bars than a pivot needs on a side")
        self.config, self.group, self.order, self.rows = config, group, order, rows
        self.names = bars.columns
        counts = stored(span_counts(bars, group, order, span), "counts")
        self.bars = numbered(bars, group, order, span, counts)
        totals = counts.groupBy("_series").agg(F.sum("n").alias("n"))
        last = F.floor((F.col("n") - 1) / rows)
        self.all = totals.select("_series", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_piece"))

    def pivoted(self) -> DataFrame:
        """The bars with _piece, pivot_kind and pivot_price, as structure.pivots() has them.

        A bar also goes to the pieces that need it as a neighbour, and is dropped there once it has served.
        """
        c = self.config
        rows = overlapping(self.bars, self.rows, c.left, c.right)
        own = W.partitionBy("_piece", "_series").orderBy("bar")
        left, right = own.rowsBetween(-c.left, -1), own.rowsBetween(1, c.right)
        whole = (F.count("*").over(left) == c.left) & (F.count("*").over(right) == c.right)
        top, bottom = F.max("high").over(right), F.min("low").over(right)
        high = (F.col("high") > F.max("high").over(left)) & (F.col("high") > top if c.strict_right else F.col("high") >= top)
        low = (F.col("low") < F.min("low").over(left)) & (F.col("low") < bottom if c.strict_right else F.col("low") <= bottom)
        rows = owned(rows.withColumn("pivot_kind", F.when(whole & high, "high").when(whole & low, "low")), self.rows)
        return rows.withColumn("pivot_price", F.when(F.col("pivot_kind") == "high", F.col("high")).when(F.col("pivot_kind") == "low", F.col("low")))

    @staticmethod
    def legs(pivoted: DataFrame) -> DataFrame:
        """_leg: which stretch of pivots of one kind of its piece a row is in, from 1 (0 before the first); _signed: the less, the more extreme."""
        own = W.partitionBy("_piece", "_series").orderBy("bar")
        before = F.last("pivot_kind", ignorenulls=True).over(own.rowsBetween(W.unboundedPreceding, -1))
        turn = F.col("pivot_kind").isNotNull() & ~F.col("pivot_kind").eqNullSafe(before)
        signed = F.when(F.col("pivot_kind") == "high", -F.col("pivot_price")).otherwise(F.col("pivot_price"))
        return pivoted.withColumns({"_turn": turn.cast("int"), "_signed": signed}).withColumn("_leg", F.sum("_turn").over(own)).drop("_turn")

    @staticmethod
    def ends(pivots: DataFrame) -> DataFrame:
        """(_series, _piece, first_stays, last_stays): the bars of a piece's first and last leg that are the best of the whole leg, over all pieces; else null.

        A piece's first leg goes on with the last leg of the piece before that has one if it is of its kind.
        """
        best = pivots.groupBy("_series", "_piece", "_leg").agg(F.min(F.struct("_signed", "bar")).alias("best"), F.first("pivot_kind").alias("kind"))
        last = F.max("_leg").over(W.partitionBy("_piece", "_series"))
        best = best.withColumn("_last", last).where((F.col("_leg") == 1) | (F.col("_leg") == F.col("_last")))
        along = W.partitionBy("_series").orderBy("_piece", "_leg")
        new = (F.col("_leg") > 1) | ~F.col("kind").eqNullSafe(F.lag("kind").over(along))
        best = best.withColumn("_new", new.cast("int")).withColumn("_whole", F.sum("_new").over(along))
        best = best.withColumn("_stays", F.col("best") == F.min("best").over(W.partitionBy("_series", "_whole")))
        bar = F.when(F.col("_stays"), F.col("best.bar"))
        return best.groupBy("_series", "_piece").agg(F.max(F.when(F.col("_leg") == 1, bar)).alias("first_stays"), F.max(F.when(F.col("_leg") == F.col("_last"), bar)).alias("last_stays"))

    @staticmethod
    def kept(legged: DataFrame, ends: DataFrame) -> DataFrame:
        """legs() rows whose pivots are those that structure.zigzag() keeps."""
        leg = W.partitionBy("_piece", "_series", "_leg").orderBy("bar").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        best = F.min(F.when(F.col("pivot_kind").isNotNull(), F.struct("_signed", "bar"))).over(leg)
        last = F.max("_leg").over(W.partitionBy("_piece", "_series"))
        rows = legged.withColumn("_best", best["bar"]).withColumn("_last", last).join(ends, ["_series", "_piece"], "left")
        at = lambda edge: F.col("bar").eqNullSafe(F.col(edge))
        settled = (F.col("_leg") > 1) & (F.col("_leg") < F.col("_last")) & at("_best")
        stays = F.col("pivot_kind").isNotNull() & (settled | at("first_stays") | at("last_stays"))
        return rows.withColumns({c: F.when(stays, F.col(c)) for c in ("pivot_kind", "pivot_price")}).drop("_best", "_last", "_signed", "first_stays", "last_stays")

    @staticmethod
    def along() -> WindowSpec:
        """A piece's bars in order. Legs ascend with bars, so rows that are sorted by both aren't sorted again."""
        return W.partitionBy("_piece", "_series").orderBy("_leg", "bar")

    def level_states(self, kept: DataFrame) -> DataFrame:
        """For each piece: the last pivots of both kinds before it, those of them that are confirmed where it starts, and those that aren't (tail)."""
        settled = F.col("bar") < (F.col("_piece") + 1) * self.rows - self.config.right
        last = lambda kind, when: F.max_by("pivot_price", F.when((F.col("pivot_kind") == kind) & when, F.col("bar")))
        sums = {f"{k}_any": last(k, F.lit(True)) for k in _KINDS} | {f"{k}_settled": last(k, settled) for k in _KINDS}
        tail = F.collect_list(F.when(~settled, F.struct("bar", "pivot_kind", "pivot_price")))
        made = kept.where("pivot_kind is not null").groupBy("_series", "_piece").agg(*(v.alias(k) for k, v in sums.items()), tail.alias("tail"))
        along = W.partitionBy("_series").orderBy("_piece")
        before = lambda c, to: F.last(c, ignorenulls=True).over(along.rowsBetween(W.unboundedPreceding, to))
        states = {f"{k}_before": before(f"{k}_any", -1) for k in _KINDS}
        states |= {f"{k}_known": F.coalesce(F.lag(f"{k}_settled").over(along), before(f"{k}_any", -2)) for k in _KINDS}
        states["tail_before"] = F.lag("tail").over(along)
        return self.all.join(made, ["_series", "_piece"], "left").select("_series", "_piece", *(v.alias(k) for k, v in states.items()))

    def levelled(self, kept: DataFrame, states: DataFrame) -> DataFrame:
        """kept() rows with _before (the pivot of the same kind before), support and resistance."""
        own, right = self.along(), self.config.right
        kind, late = F.col("pivot_kind"), F.col("bar") - right
        price = {k: F.when(kind == k, F.col("pivot_price")) for k in _KINDS}
        rows = kept.join(states, ["_series", "_piece"])
        before = {k: F.coalesce(F.last(price[k], ignorenulls=True).over(own.rowsBetween(W.unboundedPreceding, -1)), F.col(f"{k}_before")) for k in _KINDS}
        waiting = lambda k: F.get(F.filter("tail_before", lambda x: (x["bar"] == late) & (x["pivot_kind"] == k)), F.lit(0))["pivot_price"]
        in_time = {f"_{k}": F.coalesce(F.lag(price[k], right).over(own), F.when(F.col("bar") % self.rows < right, waiting(k))) for k in _KINDS}
        rows = rows.withColumns(in_time | {"_before": F.when(kind == "high", before["high"]).when(kind == "low", before["low"])})
        known = lambda k: F.coalesce(F.last(f"_{k}", ignorenulls=True).over(own), F.col(f"{k}_known"))
        gone = [f"{k}{x}" for k in _KINDS for x in ("_before", "_known")]
        return rows.withColumns({"support": known("low"), "resistance": known("high")}).drop("_low", "_high", "tail_before", *gone)

    @staticmethod
    def breaks(levelled: DataFrame) -> DataFrame:
        """_anchor, the piece's last one-sided break up to a bar (null if none yet), and _turns, its two-sided ones since; _was: both of the bar before."""
        own = Pieces.along()
        up = F.coalesce(F.col("close") > F.col("resistance"), F.lit(False))
        down = F.coalesce(F.col("close") < F.col("support"), F.lit(False))
        rows = levelled.withColumns({"_set": F.when(up & ~down, 1).when(down & ~up, -1), "_both": (up & down).cast("int")})
        rows = rows.withColumns({"_anchor": F.last("_set", ignorenulls=True).over(own), "_all": F.sum("_both").over(own)})
        rows = rows.withColumn("_then", F.last(F.when(F.col("_set").isNotNull(), F.col("_all")), ignorenulls=True).over(own))
        rows = rows.withColumn("_turns", F.col("_all") - F.coalesce("_then", F.lit(0)))
        return rows.withColumn("_was", F.lag(F.struct("_anchor", "_turns")).over(own)).drop("_set", "_both", "_all", "_then")

    @staticmethod
    def trend_after(start: Column, anchor: Column, turns: Column) -> Column:
        """The trend after breaks() of which ``anchor`` and ``turns`` are known, from a trend ``start``."""
        odd = turns % 2 == 1
        base = F.coalesce(anchor, F.when(start != 0, start))
        return F.when(base.isNotNull(), F.when(odd, -base).otherwise(base)).when(turns == 0, 0).when(odd, 1).otherwise(-1)

    def trend_states(self, broken: DataFrame) -> DataFrame:
        """(_series, _piece, trend_before): the trend that each piece starts with."""
        sums = broken.groupBy("_series", "_piece").agg(F.max_by(F.struct("_anchor", "_turns"), "bar").alias("x")).select("_series", "_piece", "x.*")
        along = W.partitionBy("_series").orderBy("_piece")
        sums = sums.withColumns({"_set": F.last("_anchor", ignorenulls=True).over(along), "_stretch": F.count("_anchor").over(along)})
        sums = sums.withColumn("_all", F.sum("_turns").over(W.partitionBy("_series", "_stretch").orderBy("_piece")))
        sums = sums.withColumn("_out", self.trend_after(F.lit(0), F.col("_set"), F.col("_all")))
        return sums.select("_series", "_piece", F.coalesce(F.lag("_out").over(along), F.lit(0)).alias("trend_before"))

    def trended(self, broken: DataFrame, states: DataFrame) -> DataFrame:
        start = F.col("trend_before")
        rows = broken.join(states, ["_series", "_piece"])
        before = F.when(F.col("_was").isNull(), start).otherwise(self.trend_after(start, F.col("_was._anchor"), F.col("_was._turns")))
        rows = rows.withColumn("trend", self.trend_after(start, F.col("_anchor"), F.col("_turns")))
        rows = rows.withColumn("event", F.when(F.col("trend") != before, F.col("trend")))
        return rows.withColumn("event_level", F.when(F.col("event") == 1, F.col("resistance")).when(F.col("event") == -1, F.col("support"))).drop("trend_before", "_anchor", "_turns", "_was")

    def result(self) -> DataFrame:
        kind, price, before = F.col("pivot_kind"), F.col("pivot_price"), F.col("_before")
        legged = self.legs(self.pivoted())
        pivots = stored(legged.where("pivot_kind is not null").select("_series", "_piece", "bar", "pivot_kind", "pivot_price", "_leg", "_signed"), "pivots")
        ends = stored(self.ends(pivots), "ends")
        levels = stored(self.level_states(self.kept(pivots, ends)), "levels")
        levelled = self.levelled(self.kept(legged, ends), levels)
        broken = stored(self.breaks(levelled), "rows")
        trends = stored(self.trend_states(broken), "trends")
        rows = self.trended(broken, trends)
        higher = before.isNull() | (price > before)
        label = F.when(kind == "high", F.when(higher, "HH").otherwise("LH")).when(kind == "low", F.when(higher, "HL").otherwise("LL"))
        flag = lambda k, up: F.coalesce((kind == k) & (price > before if up else price < before), F.lit(False)).cast("int")
        flags = {"Higher_Low": flag("low", True), "Higher_High": flag("high", True), "Lower_Low": flag("low", False), "Lower_High": flag("high", False)}
        rows = rows.withColumns(flags | {"pivot_label": label, "confirmed_at": F.when(kind.isNotNull(), F.col("bar") + self.config.right)})
        return rows.select(*(F.col(f"`{c}`") for c in self.names), *RESULT)


RESULT = (
    "bar", "pivot_kind", "pivot_price", "Higher_Low", "Higher_High", "Lower_Low", "Lower_High", "pivot_label", "confirmed_at",
    "support", "resistance", "trend", "event", "event_level",
)


def structure(bars: DataFrame, config: PivotConfig = PivotConfig(), group: tuple[str, ...] = ("symbol",), order: str = "ts", rows: int = ROWS, span: str = "month") -> DataFrame:
    """bars with RESULT: what pivots(), zigzag(), swing_flags(), structure_labels(), levels() and trend() of structure.py give, piece by piece.

    rows: bars of a piece; span: a unit of time (as for date_trunc) whose bars of a series a task can count.
    """
    if clash := {c.lower() for c in bars.columns} & ({c.lower() for c in RESULT} | {*_OWN}):
        raise ValueError(f"columns exist already: {sorted(clash)}")
    return Pieces(bars, config, group, order, rows, span).result()


def trend_now(structured: DataFrame, group: tuple[str, ...] = ("symbol",), order: str = "ts") -> DataFrame:
    """structure.trend_now() of structure()'s result: sums and, of each task, a series' last four labels."""
    key = F.struct(*group).alias("_series")
    last = structured.groupBy(key).agg(F.max(F.struct(order, "trend", "support", "resistance")).alias("_last"), F.count("pivot_label").alias("n_pivots"))
    late = F.row_number().over(W.partitionBy("_series").orderBy(F.desc(order)))
    labels = structured.where("pivot_label is not null").select(key, order, "pivot_label").withColumn("_late", late).where("_late <= 4")
    has = lambda *names: F.max(F.col("pivot_label").isin(*names))
    rows = last.join(labels.groupBy("_series").agg(has("HH", "HL").alias("_up"), has("LH", "LL").alias("_down")), "_series", "left")
    guess = F.when(F.col("n_pivots") < 2, 0).when(F.col("_up"), 1).when(F.col("_down"), -1).otherwise(0)
    trend = F.when(F.col("_last.trend") != 0, F.col("_last.trend")).otherwise(guess).alias("trend")
    return rows.select(*(F.col(f"_series.{c}").alias(c) for c in group), trend, F.col("_last.support").alias("support"), F.col("_last.resistance").alias("resistance"), "n_pivots")
