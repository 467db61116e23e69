"""The registered queries of the operators in this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact, fingerprint, jaccard, langid, lines, mixing, negatives, pii, quality, repeats, token_counts, token_ids
from .common import Tables, read


def vocabulary(name: str) -> str:
    """A vocabulary file of the public tokenizers that are installed beside Spark."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs)
    return langid.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", (~langid.is_training(F.col("doc_id"))).alias("held_out"), "lang_pred", "score", "entropy", "rejected"
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup(read(spark, sf_dir, "documents").select("doc_id", "text"), tau=2, per_edit=20)
    return kept.select("doc_id", "n_lines", "n_exact", "n_near", "emptied", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(read(spark, sf_dir, "documents").select("doc_id", "text"), size=4, num=85, den=100)


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    tables = Tables(spark, "token_ids", lasting=True)
    written = token_ids.write(read(spark, sf_dir, "documents"), f"{tables.root}/files", vocabulary("byte_bpe_50k.json"), public_tokenizers.PATTERN, end_id=2)
    return token_ids.read_back(tables.put(written, "manifest"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs))

    def joined(spans: str):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    counts = [F.aggregate("base", F.lit(0).cast("long"), _adder(kind)).alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def _adder(kind: str):
    return lambda n, x: n + F.when(x["kind"] == kind, 1).otherwise(0)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.digests(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_edited(read(spark, sf_dir, "documents"), fingerprint.Sketch(bins=256, bits=4, words=5))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.verdicts(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), risk=0.02, delta=0.05)
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), public_tokenizers.PATTERN, limit=1024)


def domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of labels: toxic, else poor or good by quality."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").when(F.col("quality") == 1, "good").alias("domain"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels")
    return mixing.rates(docs, domains(labels), targets={"good": 0.8, "poor": 0.1, "toxic": 0.0})


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return negatives.mine(rows, F.col("vec_id") % 100 == 0, positives=5, negatives=5, share=(80, 100), scale=256)


def looped(text: Column, doc_id: Column) -> Column:
    """The text; where h % 10 = 0 its words, joined by spaces, loop from word a on with period p."""
    words = F.regexp_extract_all(text, F.lit("([^\\x20\\x09-\\x0D]+)"), F.lit(1))
    h = F.crc32(doc_id.cast("string"))
    g, n = F.floor(h / 10), F.size(words)
    a = (g % F.when(n > 0, n)).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    loop = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
    return F.when((h % 10 == 0) & (n > 0), F.array_join(F.concat(F.slice(words, F.lit(1), a), loop), " ")).otherwise(text)


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", looped(F.col("text"), F.col("doc_id")).alias("text"))
    found = repeats.find(docs, exponent=4, shortest=6).withColumn("best", repeats.best("runs"))
    each = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(each, lambda r: F.concat(r, F.lit("\n"))), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return exact.groups(docs.withColumn("text_sha256", F.sha2(exact.normalised(F.col("text")), 256))).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def queries() -> dict:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


#: Queries that DuckDB can express over whole tables.
ORACLE_SQL: dict[str, str] = {
    "op11_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
                   FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.e, b.e)::BIGINT AS score
              FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
    """,
    "op13_exact_dedup": r"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[ \t\n\x0B\f\r]+', ' ', 'g') AS norm FROM documents),
        h AS (SELECT doc_id, sha256(norm) AS text_sha256 FROM t),
        g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM h GROUP BY 1)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM h JOIN g USING (text_sha256)
    """,
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
