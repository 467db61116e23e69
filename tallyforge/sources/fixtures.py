"""Bars and dirty raw rows derived from the tables that the driver provides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_parquet


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as one-tick bars: symbol, ts, src_row, open = high = low = close, volume 1."""
    return as_ticks(read_parquet(spark, sf_dir, "events"))


def tick_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ticks() as a streaming table."""
    table = read_parquet(spark, sf_dir, "events")
    stream = spark.readStream.schema(table.schema)
    if any(f.endswith("/events.parquet") for f in table.inputFiles()):  # one file: a stream's source is a folder
        return as_ticks(stream.option("pathGlobFilter", "events.parquet").parquet(sf_dir))
    return as_ticks(stream.parquet(f"{sf_dir}/events.parquet"))


def as_ticks(e: DataFrame) -> DataFrame:
    price = F.col("value").cast("decimal(18,2)")
    return e.select(F.col("event_type").alias("symbol"), "ts", F.col("event_id").alias("src_row"), *(price.alias(c) for c in ("open", "high", "low", "close")), F.lit(1).cast("long").alias("volume"))


#: Divisor of the id, rule. The first that divides applies.
RULES = (
    (97, "r01"), (89, "r02a"), (83, "r02b"), (79, "r02c"), (73, "r03a"), (71, "r03b"), (67, "r03c"), (61, "r05"), (59, "r06"),
    (53, "r07"), (47, "r08"), (43, "r09"), (41, "r10"), (37, "r11"), (29, "r05s"),
)


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text row an event, some spoilt by rule and some doubled, in the order of src_row.

    The finished rows leave an explode, so what reads them doesn't repeat the rules' expressions.
    """
    e = read_parquet(spark, sf_dir, "events")
    i = F.col("id")
    rule = F.lit(None).cast("string")
    for by, name in reversed(RULES):
        rule = F.when(i % by == 0, name).otherwise(rule)
    minute = F.date_trunc("minute", "ts")
    price = (100 + F.round(F.col("value").cast("decimal(18,2)") * 4) / 4).cast("decimal(18,2)")
    rows = e.select(F.col("event_id").alias("id"), F.col("user_id").alias("u"), minute.alias("m"), price.alias("p"))
    rows = rows.withColumn("rule", rule)

    def when(cases: list[tuple[str, Column]], usual: Column) -> Column:
        out = usual
        for name, value in cases:
            out = F.when(F.col("rule") == name, value).otherwise(out)
        return out

    text = lambda c: c.cast("decimal(18,2)").cast("string")
    stamp = lambda form: F.date_format("m", form)
    usual = F.element_at(F.array(*map(F.lit, ("NQH6", "NQM6", "NQU6", "NQZ6"))), (F.col("u") % 4 + 1).cast("int"))
    by_three = lambda a, b, c: F.when(i % 3 == 0, a).when(i % 3 == 1, b).otherwise(c)
    p = F.col("p")

    def made(k: int) -> Column:
        return F.struct(
            (i * 2 + k).alias("src_row"),
            when([("r02a", stamp("yyyy-MM-dd'T'HH:mm:ss")), ("r02b", stamp("'1999'-MM-dd'T'HH:mm:ss'.000000000Z'")), ("r02c", stamp("yyyy-MM-dd'T'HH:mm:'30.000000000Z'"))], stamp("yyyy-MM-dd'T'HH:mm:ss'.000000000Z'")).alias("ts_event"),
            F.lit("33").alias("rtype"), F.lit("1").alias("publisher_id"), F.col("u").cast("string").alias("instrument_id"),
            when([("r07", by_three(F.lit("abc"), F.lit("NaN"), F.lit("-1")))], text(p)).alias("open"),
            when([("r08", text(p - F.lit("1.25").cast("decimal(4,2)")))], text(p + 1)).alias("high"),
            text(p - F.lit("0.25").cast("decimal(4,2)")).alias("low"),
            when([("r09", text(p + F.lit("0.10").cast("decimal(4,2)"))), ("r06", text(p + F.lit("0.25").cast("decimal(4,2)") * k))], text(p)).alias("close"),
            when([("r10", by_three(F.lit("x"), F.lit("-3"), F.lit("1.5"))), ("r11", F.lit("0"))], (1 + i % 500).cast("string")).alias("volume"),
            when([("r01", F.lit(" ")), ("r03a", F.lit("NQU6-NQZ6")), ("r03b", F.lit("NQU6 C20000")), ("r03c", F.when(i % 2 == 0, "ESU6").otherwise("???")), ("r05s", F.when(usual == "NQZ6", "NQH7").otherwise("NQZ6"))], usual).alias("symbol"),
        )

    both = F.when(F.col("rule").isin("r05", "r06"), F.array(made(0), made(1))).otherwise(F.array(made(0)))
    return rows.select(F.explode(both).alias("x")).select("x.*")


#: What is put before and after the text of a price on the grid, by the id modulo their number.
AROUND = (("", ""), ("", "0000000000"), ("", "0000001"), ("", "00005"), ("1000000000", ""), ("1000000000", "1"), ("", "000025"), ("", "00002499999999"))


def long_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row an event with prices as texts of up to 16 digits before and after the point; some envelopes and prices are spoilt."""
    e = read_parquet(spark, sf_dir, "events")
    price = (100 + F.round(F.col("value").cast("decimal(18,2)") * 4) / 4).cast("decimal(18,2)").cast("string")
    i, text = F.col("event_id"), F.lit(None).cast("string")
    for k, (before, after) in enumerate(AROUND):
        text = F.when(i % len(AROUND) == k, F.concat(F.lit(before), price, F.lit(after))).otherwise(text)
    rows = e.select(i.alias("event_id"), text.alias("open"))
    above, zero = F.concat(F.lit("9"), F.col("open")), F.lit("0.000000000000")
    return rows.select(
        "event_id", "open", F.when(i % 3 == 0, above).otherwise(F.col("open")).alias("high"), F.when(i % 7 == 0, above).when(i % 11 == 0, zero).otherwise(F.col("open")).alias("low"), F.col("open").alias("close"),
    )
