"""Corpus pipeline: five operators of tallyforge.llm, one stage after another.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; all but the last return the columns of
documents. run() writes each stage as Parquet in the shared folder and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import bpe, jaccard, langid, lines, mixing
from tallyforge.llm.common import Tables, made, read, release
from tallyforge.llm.queries import domains, vocabulary


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others' lang is the predicted one."""
    found = langid.predict(docs, langid.fit(docs), prefix="id_").where("not id_rejected")
    return found.select(*(F.col("id_lang_pred").alias("lang") if c == "lang" else F.col(c) for c in docs.columns))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of lines go; so does a document whose every line with a word was a copy."""
    found = lines.dedup(docs, tau=2, per_edit=20).where("not emptied")
    return found.select(*(F.length("text").cast(docs.schema["n_chars"].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays: the one with the smallest doc_id.

    Five words a shingle and a Jaccard similarity of 0.8. A document without words is in no class. Of rows
    with the same doc_id and text one stays; texts that share a doc_id or have none are documents of their
    own, null doc_ids last.
    """
    tables = Tables(spark, "near_duplicates")
    repeated = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("repeated"))
    repeated = tables.put(repeated, "repeated")
    if not (repeated.isEmpty() and docs.where("doc_id is null").isEmpty()):
        return _unnamed_too(tables, docs, repeated)
    found = jaccard.classes(docs, size=5, num=80, den=100).where("doc_id is not null and component_id <> doc_id")
    gone = tables.put(found.select(F.col("doc_id").alias("gone")).distinct(), "gone")
    return docs.join(gone, F.col("doc_id") == F.col("gone"), "left_anti")


def _unnamed_too(tables: Tables, docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """near_duplicates() where rows of a repeated or null doc_id are named by a hash of it and their text."""
    known = docs.join(repeated, F.col("doc_id") == F.col("repeated"), "left")
    odd = F.col("doc_id").isNull() | F.col("repeated").isNotNull()
    named = known.where(~odd).withColumn("name", F.col("doc_id").cast("long")).drop("repeated")
    unnamed = known.where(odd).dropDuplicates(["doc_id", "text"]).withColumn("name", F.xxhash64("doc_id", "text", F.lit("name"))).drop("repeated")
    rows = tables.put(named.unionByName(unnamed), "rows")
    found = tables.put(jaccard.classes(rows.select(F.col("name").alias("doc_id"), "text"), size=5, num=80, den=100), "classes").select(F.col("doc_id").alias("member"), "component_id")
    ranked = found.join(rows.select("name", "doc_id"), F.col("member") == F.col("name"))
    first = ranked.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "name")).alias("first")).select("component_id", "first.name")
    gone = found.join(first, "component_id").where("member <> name").select("member").distinct()
    return rows.join(tables.put(gone, "gone"), F.col("name") == F.col("member"), "left_anti").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The target of toxic documents is 0, other domains keep their share; a document stays if its rate rounds to 1 or more."""
    found = mixing.rates(docs, domains(read(spark, sf_dir, "labels")), targets={"toxic": 0.0}, mark="mix_", keep_text=True)
    return found.where("mix_rate >= 0.5").select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids of each document's text, and of what they decode to."""
    import public_tokenizers

    return bpe.digests(docs, vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", language),
    ("line_dedup", line_dedup),
    ("jaccard_join", near_duplicates),
    ("mixing", mixed),
    ("byte_bpe", encoded),
]

#: SQL can't express the models' stages; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages' tables are written one after another; a stage's own intermediate tables go when it is written, its input too."""
    tables, docs = Tables(spark, "pipeline", lasting=True), read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        before, since = docs, made()
        docs = tables.put(stage(spark, docs, sf_dir), name)
        release(spark, since)
        if i:
            tables.drop(before)
    return docs
