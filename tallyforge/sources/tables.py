"""CSV and Parquet sources: header rules, ragged rows, row numbers, column aliases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BAD = "_ragged_record"
#: Blocks of files, of some 200 bytes, up to which all executors get the table of their numbers; more are joined in a shuffle.
BROADCAST_ROWS = 200_000
#: A quoted field, or one whose quotes don't end, once doubled quotes are gone.
_QUOTED = r'(^|,)"[^"]*("|$)'

#: Names that a column may have, the preferred one first.
ALIASES = {
    "ts": ("ts_utc", "ts_event", "timestamp", "datetime", "date_time", "time", "date"),
    "open": ("open", "o"),
    "high": ("high", "h"),
    "low": ("low", "l"),
    "close": ("close", "c", "last"),
    "volume": ("volume", "vol", "size"),
}


def plain(name: str) -> str:
    """A header's name without byte order mark and white space, in lower case."""
    return name.lstrip("﻿").strip().lower()


def header_of(spark: SparkSession, path: str, encoding: str = "utf-8") -> list[str]:
    """The names in a CSV file's first line, as they stand there."""
    first = spark.read.option("header", False).option("encoding", encoding).option("escape", '"').option("multiLine", True).csv(path).first()
    if first is None:
        raise ValueError(f"{path} has no header")
    return [(x or "").lstrip("﻿") for x in first]


def require(columns: list[str], wanted: tuple[str, ...], reserved: tuple[str, ...] = ()) -> None:
    """Fails on missing, repeated or reserved names."""
    if missing := [c for c in wanted if c not in columns]:
        raise ValueError(f"missing columns: {missing}")
    if len(set(columns)) != len(columns):
        raise ValueError(f"repeated columns in {columns}")
    if clash := set(columns) & set(reserved):
        raise ValueError(f"reserved columns: {sorted(clash)}")


def field_count(record: Column) -> Column:
    """Number of fields of a CSV record: its commas outside quoted fields and one. Quotes count at a field's start only.

    Each step is one pass over the record, so a long one is no worse than its length.
    """
    text = F.replace(F.regexp_replace(record, r"[\r\n]+$", ""), F.lit('""'), F.lit(""))
    bare = F.regexp_replace(text, _QUOTED, "$1")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def _dense(df: DataFrame) -> DataFrame:
    """df, read from files, with src_row: its records numbered from 2 without gaps, over all files by path.

    A file's blocks may be read by different tasks. A first pass counts each block's records; sums of the
    counts before it, and the place of a record in its block, are its number.
    """
    placed = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"))
    blocks = placed.groupBy("_file", "_block").agg(F.count("*").alias("n"), F.min("_id").alias("_first"))
    files = blocks.groupBy("_file").agg(F.sum("n").alias("n"))
    before = F.coalesce(F.sum("n").over(W.orderBy("_file").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    files = files.select("_file", before.alias("_files"))
    in_file = F.coalesce(F.sum("n").over(W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.withColumn("_before", in_file).join(files, "_file").select("_file", "_block", "_first", (F.col("_before") + F.col("_files")).alias("_before"))
    # a block has openCostInBytes or more, unless it is a file's last
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = df.sparkSession._jsparkSession.sessionState().conf().filesOpenCostInBytes()
    if len(df.inputFiles()) + size // max(least, 1) <= BROADCAST_ROWS:
        blocks = F.broadcast(blocks)
    rows = placed.join(blocks, ["_file", "_block"]).withColumn("src_row", F.col("_before") + F.col("_id") - F.col("_first") + 2)
    return rows.select(*(F.col(f"`{c}`") for c in df.columns), "src_row")


def read_csv(spark: SparkSession, path: str, ragged: str = "tolerate", encoding: str = "utf-8", required: tuple[str, ...] = (), numbered: bool = True, multi_line: bool = True) -> DataFrame:
    """All columns as text, as the header names them; src_row is the record's place in its file (header 1).

    ragged: "tolerate" drops fields too many and pads missing ones with null, "long" fails on records
    with too many fields, "any" on each whose number of fields differs. Records may hold line feeds, so a
    file is one task; ``multi_line=False`` says that none does, so that large files are split. Several files
    are numbered on from one to the next, by path. Numbers cost a split or second file a pass that counts.
    """
    if ragged not in ("tolerate", "long", "any"):
        raise ValueError(f"unknown rule for ragged rows: {ragged}")
    names = header_of(spark, path, encoding)
    require(names, required, ("src_row", _BAD))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, _BAD)])
    df = (
        spark.read.schema(schema).option("header", True).option("encoding", encoding).option("escape", '"').option("multiLine", multi_line)
        .option("enforceSchema", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD).csv(path)
    )
    if numbered and multi_line and len(df.inputFiles()) == 1:
        df = df.withColumn("src_row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 2)
    elif numbered:
        df = _dense(df)
    if ragged != "tolerate":
        width = field_count(F.col(_BAD))
        wrong = width > len(names) if ragged == "long" else width != len(names)
        # Spark refuses to read the raw record alone, so the message also names a column
        fail = F.raise_error(F.concat_ws("", F.lit("a record has another number of fields than the header: "), F.col(_BAD), F.substring(F.col(f"`{names[0]}`"), 1, 0))).cast("boolean")
        df = df.where(F.when(F.col(_BAD).isNotNull() & wrong, fail).otherwise(F.lit(True)))
    return df.drop(_BAD)


def resolve(df: DataFrame, wanted: tuple[str, ...] = ("ts", "open", "high", "low", "close"), optional: tuple[str, ...] = ("volume",)) -> DataFrame:
    """df with the columns of ALIASES renamed to their keys, whatever case they have; others stay."""
    by_plain: dict[str, str] = {}
    for c in df.columns:
        if plain(c) in by_plain:
            raise ValueError(f"columns {by_plain[plain(c)]!r} and {c!r} differ in case only")
        by_plain[plain(c)] = c
    names = {}
    for key in (*wanted, *optional):
        found = next((by_plain[a] for a in ALIASES[key] if a in by_plain), None)
        if found is None and key in wanted:
            raise ValueError(f"no column for {key}: one of {ALIASES[key]} is needed")
        if found is not None:
            names[found] = key
    return df.select(*(F.col(f"`{c}`").alias(names.get(c, c)) for c in df.columns))


def read_parquet(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
