"""Writing step results, previews and charts."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import escape
from pathlib import Path

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.cleaning import REASONS, StepResult, Steps

#: Fixed value: the name of the table of large moves, in every folder.
LARGE_MOVES = "Large_up_down"


def write_csv(df: DataFrame, path: str, order: str | None = None) -> None:
    """A folder of CSV files; the committer makes them visible when the job has ended well.

    With ``order`` (src_row) the files, taken by name, have their rows in the order of that column.
    """
    rows = df.orderBy(order) if order else df
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_split(result: StepResult, path: str) -> None:
    """Kept and rejected rows of a step in one pass: folders rejected=0 and rejected=1 (Spark reads a partition column's 0 and 1 as int).

    Kept rows have the columns that the step adds; in rejected ones these are null.
    """
    result.both.withColumn("rejected", F.col("reject_reason").isNotNull().cast("int")).write.mode("overwrite").partitionBy("rejected").parquet(path)


@dataclass
class Written:
    """Where a chain's tables stand, and how many rows came, stayed and were rejected by step and reason."""

    paths: dict[str, str]
    rows: int
    kept: int
    rejected: dict[tuple[int, str], int]


def write_steps(results: Steps, folder: str, order: str = "src_row", large_moves: str | None = None) -> Written:
    """A chain's tables as folders of CSV files: what the last step kept, all rejects, all audits.

    The source is read once: the chain's rows go to ``tagged`` (Parquet, with failed_step and reject_reason) and are
    counted on the way; everything else is read from there. Rejects stand as they came, in folders
    failed_step=N, written by the tasks that read them, so a step with many is not one task's. Large moves have a
    name of their own (LARGE_MOVES) unless ``large_moves`` is a path for them.
    """
    tagged = f"{folder}/tagged"
    seen = Observation()
    failed, reason = F.col("failed_step"), F.col("reject_reason")
    counts = {"rows": F.count(F.lit(1)), "kept": F.count_if(failed.isNull())} | {f"{n}:{r}": F.count_if((failed == n) & (reason == r)) for n, r in REASONS if n <= len(results)}
    results.whole.observe(seen, *(v.alias(k) for k, v in counts.items())).write.mode("overwrite").parquet(tagged)
    found = seen.get
    spark = results.whole.sparkSession
    steps = Steps(spark.read.schema(results.whole.schema).parquet(tagged), results.names, results.config, len(results))

    paths = {"tagged": tagged} | {name: f"{folder}/{name}" for name in ("kept", "rejects")}
    write_csv(steps[-1].kept, paths["kept"], order)
    rejects = steps.whole.where("failed_step is not null").drop("ts_utc")
    rejects.sortWithinPartitions("failed_step", order).write.mode("overwrite").option("header", True).option("escape", '"').partitionBy("failed_step").csv(paths["rejects"])
    for i in (4, 5, 12):
        for name, audit in steps[i - 1].audits.items() if i <= len(steps) else ():
            own = large_moves or f"{folder}/{LARGE_MOVES}"
            paths[name] = own if name == "large_moves" else f"{folder}/step{i:02d}_{name}"
            write_csv(audit, paths[name])
    rejected = {(int(n), r): found[f"{n}:{r}"] for n, r in REASONS if found.get(f"{n}:{r}")}
    return Written(paths, found["rows"], found["kept"], rejected)


def reason_counts(tagged: DataFrame) -> DataFrame:
    return tagged.groupBy(F.coalesce("reject_reason", F.lit("KEPT")).alias("reason")).agg(F.count("*").alias("n_rows"))


def tail(df: DataFrame, n: int | None, *order: str) -> DataFrame:
    """The last n rows by ``order``; all if n is None or 0."""
    if not n:
        return df
    if n < 2:
        raise ValueError("a tail has 2 rows or more")
    return df.orderBy(*(F.desc(c) for c in order)).limit(n)


def numbered_file(folder: str | Path, prefix: str, day: str, time: str, suffix: str = ".svg") -> Path:
    """The next free name prefix_day_time_number; numbers have four digits and start anew each day."""
    taken = [int(m[1]) for p in Path(folder).glob(f"{prefix}_{day}_*{suffix}") if (m := re.search(r"_(\d+)\Z", p.stem))]
    return Path(folder) / f"{prefix}_{day}_{time}_{max(taken, default=0) + 1:04d}{suffix}"


def safe_stem(name: str) -> str:
    return "".join(c if c.isalnum() or c in "_-" else "_" for c in name)


def price_text(price: float) -> str:
    whole, _, cents = f"{price:,.2f}".partition(".")
    cents = cents.rstrip("0")
    return f"{whole}.{cents}" if cents else whole


def candle_svg(bars: DataFrame, path: str | Path, title: str = "", last: int = 240) -> None:
    """A candlestick chart of the last bars, with axes of price and time.

    bars: ts, open, high, low, close, and what of the structure is to be shown: support, resistance, pivot_kind and
    pivot_label, event and event_level, trend. The driver draws; it receives ``last`` rows.
    """
    if last < 30:
        raise ValueError("a chart shows 30 bars or more")
    rows = sorted((r.asDict() for r in tail(bars, last, "ts").collect()), key=lambda r: r["ts"])
    if not rows:
        raise ValueError("no bars to draw")
    wide, tall, edge, floor = 1200, 640, 80, 590
    levels = {k: float(v) for k in ("support", "resistance") if (v := rows[-1].get(k)) is not None}
    top = max([float(r["high"]) for r in rows] + [*levels.values()])
    low = min([float(r["low"]) for r in rows] + [*levels.values()])
    step, span = (wide - 2 * edge) / len(rows), max(top - low, 1e-9)
    y = lambda v: 60 + (top - float(v)) / span * (floor - 70)
    text = lambda x, at, what, more="": out.append(f'<text x="{x:.1f}" y="{at:.1f}" font-size="12" text-anchor="middle" {more}>{escape(what)}</text>')
    line = lambda x1, y1, x2, y2, more: out.append(f'<line x1="{x1:.1f}" y1="{y1:.1f}" x2="{x2:.1f}" y2="{y2:.1f}" {more}/>')
    out = [f'<svg xmlns="http://www.w3.org/2000/svg" width="{wide}" height="{tall}"><title>{escape(title)}</title><rect width="100%" height="100%" fill="white"/>']
    trend = rows[-1].get("trend")
    text(wide / 2, 28, " · ".join(x for x in (title, {1: "trend up", -1: "trend down", 0: "no trend"}.get(trend, "")) if x), 'class="heading"')
    for k in range(6):
        price = low + span * k / 5
        line(edge, y(price), wide - edge, y(price), 'stroke="#ddd" class="grid"')
        text(edge / 2, y(price) + 4, price_text(price), 'class="price"')
    for i in sorted({round(k * (len(rows) - 1) / 7) for k in range(8)}):
        text(edge + (i + 0.5) * step, floor + 24, f"{rows[i]['ts']:%m-%d %H:%M}" if hasattr(rows[i]["ts"], "strftime") else str(rows[i]["ts"]), 'class="time"')
    for i, r in enumerate(rows):
        x, colour = edge + (i + 0.5) * step, "#2a7" if r["close"] >= r["open"] else "#c33"
        line(x, y(r["high"]), x, y(r["low"]), f'stroke="{colour}"')
        a, b = sorted((y(r["open"]), y(r["close"])))
        out.append(f'<rect x="{x - step * 0.35:.1f}" width="{step * 0.7:.1f}" y="{a:.1f}" height="{max(b - a, 1):.1f}" fill="{colour}"/>')
    for i, r in enumerate(rows):
        x = edge + (i + 0.5) * step
        if kind := r.get("pivot_kind"):
            at, label = y(r[kind]), r.get("pivot_label") or ""
            out.append(f'<circle cx="{x:.1f}" cy="{at:.1f}" r="3" fill="{"#c33" if label in ("LH", "LL") else "#2a7" if label else "#36c"}"/>')
            if label:
                text(x, at - 8 if kind == "high" else at + 16, label, 'class="pivot"')
        if event := r.get("event"):
            level = r.get("event_level")
            at = y(r["close"] if level is None else level)
            text(x, at + 4, "▲" if event > 0 else "▼", f'class="event" fill="{"#36c" if event > 0 else "#e70"}"')
    for name, level in levels.items():
        colour = "#2a7" if name == "support" else "#c33"
        line(edge, y(level), wide - edge, y(level), f'stroke="{colour}" stroke-dasharray="4"')
        text(wide - edge / 2, y(level) + 4, price_text(level), f'class="{name}" fill="{colour}"')
    Path(path).write_text("\n".join([*out, "</svg>"]), encoding="utf-8")
