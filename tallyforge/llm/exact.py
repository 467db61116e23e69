"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash.

Texts are equal when they are identical after each run of white space (space, tab to carriage return) is
replaced by one space. Everything is a DataFrame expression:

1. One scan counts rows by (length, hash of the first characters) of the normalised text. A length that one
   row alone has settles that row; so does, within the other lengths, a prefix hash that is alone.
2. The next scan marks the rows of what survives and takes the SHA-256 of those rows' whole text, of no
   other's. What it writes is compact: the columns to carry, a row number and the hash.
3. The hashes are counted; each row of a group finds the row that stays by a join, in which AQE can split a
   large group. Rows that an earlier step settled go around that join.

Counts and minima are partial before each shuffle, so a group of copies that holds a third of all rows is
one row a task there.

Rows: a null text counts as empty, and empty texts are equal. The smallest doc_id stays, a null one only if
there is no other; of repeated rows of that doc_id one stays. Extra columns are carried along; one whose
name is that of a result column raises ValueError. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Tables

#: Characters of a text that the second step hashes.
PREFIX = 64
#: Surviving (length, prefix hash) pairs, of 16 bytes, up to which they are sent to each executor.
BROADCAST_ROWS = 500_000

RESULT = ("keep_id", "group_size", "kept")


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def groups(docs: DataFrame, prefix: int = PREFIX, most: int = BROADCAST_ROWS) -> DataFrame:
    """docs' columns but text, with keep_id, group_size and kept: a row for each of docs, dropped ones too.

    With more than ``most`` surviving keys they aren't broadcast; the rows then meet them in a shuffle, and
    every row takes its hash before it, so that no text is shuffled.
    """
    taken = {c.lower() for c in docs.columns} & {*RESULT, "_n", "_prefix", "_row", "_hash"}
    if taken:
        raise ValueError(f"columns that the result names itself: {sorted(taken)}")
    tables = Tables(docs.sparkSession, "exact")
    carried = [c for c in docs.columns if c.lower() != "text"]
    rows = docs.withColumn("_text", normalised(F.col("text"))).select(*carried, "_text", F.length("_text").alias("_n"), F.xxhash64(F.substring("_text", 1, prefix)).alias("_prefix"))

    sizes = tables.put(rows.groupBy("_n", "_prefix").agg(F.count("*").alias("rows")), "sizes")
    lengths = sizes.groupBy("_n").agg(F.sum("rows").alias("rows")).where("rows > 1").select("_n")
    keys = tables.put(sizes.where("rows > 1").join(lengths, "_n", "left_semi").select("_n", "_prefix", F.lit(True).alias("_alive")), "keys")

    whole = F.sha2("_text", 256)
    if keys.limit(most + 1).count() <= most:
        marked = rows.join(F.broadcast(keys), ["_n", "_prefix"], "left").withColumn("_hash", F.when(F.col("_alive"), whole))
    else:
        marked = rows.withColumn("_hash", whole).drop("_text").join(keys, ["_n", "_prefix"], "left").withColumn("_hash", F.when(F.col("_alive"), F.col("_hash")))
    marked = tables.put(marked.select(*carried, "_hash", F.monotonically_increasing_id().alias("_row")), "marked")

    alone = marked.where("_hash is null").select(*carried, F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("first")
    found = marked.where("_hash is not null").groupBy("_hash").agg(first, F.count("*").alias("group_size"))
    found = tables.put(found.select(F.col("_hash").alias("_group"), F.col("first.doc_id").alias("keep_id"), F.col("first._row").alias("_first"), "group_size"), "groups")
    copies = marked.where("_hash is not null").join(found, F.col("_hash") == F.col("_group"))
    return alone.unionByName(copies.select(*carried, "keep_id", "group_size", (F.col("_row") == F.col("_first")).alias("kept")))
