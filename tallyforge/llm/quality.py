"""Quality rules whose cutoffs are chosen so that few good documents are rejected, with a guarantee.

A rule rejects a document whose measure exceeds a cutoff. The cutoffs of a stratum (a document's language)
come from labelled rows, which nothing else is fitted on. A level of strictness is the vector of the five
cutoffs beyond which a given share of the good ones of a fixed half of the labelled rows lies (or multiples
of their largest measures), and its verdict is that of all rules together. On the other half, down the fixed list of levels from lenient to
strict, a level is certified while the exact binomial (Clopper-Pearson) upper bound of the joint verdict's
false rejection rate stays at or under ``risk``. Testing in that fixed order needs no correction over
levels; the strata share the error ``delta`` by Bonferroni. With probability 1 - delta, then, no certified
level of any stratum rejects over ``risk`` of its good documents. Of these the most lenient one holds that
rejects as many labelled poor documents as the strictest does; if that is none, the rules stay off there.

To certify anything a stratum needs log(delta / strata) / log(1 - risk) distinct good documents in the second
half. Those with under four times as many, which could hardly afford a rejected one, are pooled into one.
Equal texts of a stratum count once, as the bound is one of independent trials.

Rows: a null text has no words. Labels whose doc_id or quality is null are left out; of contradicting ones
of a document both count. A null language is a stratum of its own, apart from the empty string. Without
labels only the base rule holds. Extra columns aren't returned.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Tables, lean
from .text import U, chunks, flat, mix, prefix_hash, span_hash, windows, words

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_WINDOW = 5

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def rules() -> dict[str, Column]:
    """Each rule's measure; the more, the worse."""
    per_word = 1.0 / F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbols": F.col("n_symbols") * per_word, "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeats": F.col("n_repeat_words") * per_word, "long_words": F.col("word_chars") * per_word, "short_words": F.col("n_words") / F.greatest(F.col("word_chars"), F.lit(1)),
    }


#: Shares of good documents beyond a rule's cutoff, lenient first.
#: Before these come the largest measures among the good ones, times FACTORS.
FACTORS = (3.0, 2.0, 1.5, 1.2)
LEVELS = (0.0, 0.001, 0.002, 0.003, 0.005, 0.0075, 0.01, 0.015, 0.02)


#: Strata, of some 600 bytes, up to which the table of their levels is sent to all executors.
BROADCAST_STRATA = 10_000


def _by_doc(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc[values], minlength=n)


def measure_chunk(buf: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    n = len(at) - 1
    starts, ends, doc = words(buf, at)
    inside = np.zeros(len(buf) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    inside = np.cumsum(inside[:-1]).astype(bool)
    sums = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[at])
    total, down = prefix_hash(buf)
    # lines: they end at line feeds and at the end of a text
    cuts = np.flatnonzero(buf == 10)
    line_doc = np.concatenate([np.searchsorted(at, cuts, "right") - 1, np.arange(n)])
    line_end = np.concatenate([cuts, at[1:]])
    order = np.lexsort((line_end, line_doc))
    line_doc, line_end = line_doc[order], line_end[order]
    line_start = np.concatenate([[0], line_end[:-1] + 1])
    new = np.ones(len(line_doc), bool)
    new[1:] = line_doc[1:] != line_doc[:-1]
    line_start[new] = at[line_doc[new]]
    worded = np.concatenate([[0], np.cumsum(inside)])
    real = worded[line_end] > worded[line_start]
    lines, owner = span_hash(total, down, line_start[real], line_end[real]), line_doc[real]
    by = np.lexsort((lines, owner))
    lines, owner = lines[by], owner[by]
    again = np.flatnonzero((lines[1:] == lines[:-1]) & (owner[1:] == owner[:-1])) + 1
    # windows of words that stand in their text twice or more
    word = span_hash(total, down, starts, ends)
    h, wdoc, first = windows(word, doc, n, _WINDOW)
    key = mix(h + wdoc.astype(U) * U(0x9E3779B97F4A7C15))
    by = np.argsort(key)
    key = key[by]
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = key[1:] == key[:-1]
    twice = first[by[same[:-1] | same[1:]]]
    cover = np.zeros(len(word) + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + _WINDOW, -1)
    return [
        np.bincount(doc, minlength=n), sums(inside & ((buf & 0xC0) != 0x80)), sums(_SYMBOL[buf]), _by_doc(again, owner, n),
        _by_doc(np.flatnonzero(np.cumsum(cover[:-1]) > 0), doc, n), np.bincount(owner, minlength=n),
    ]


def measures(docs: DataFrame) -> DataFrame:
    """The MEASURES of every row's text beside its other columns; n_lines counts the lines that have a word."""
    beside = [f for f in docs.schema.fields if f.name != "text"]
    if clash := {f.name.lower() for f in beside} & set(MEASURES):
        raise ValueError(f"docs has columns {sorted(clash)} already")

    def run(batches):
        for b in batches:
            buf, at = flat(b["text"])
            for i, j, own, own_at in chunks(buf, at):
                rest = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*(rest[f.name] for f in beside), *(pa.array(x.astype(np.int64)) for x in measure_chunk(own, own_at))], [*(f.name for f in beside), *MEASURES])

    kinds = T.StructType([*beside, *(T.StructField(x, T.LongType()) for x in MEASURES)])
    return docs.select(*(f.name for f in beside), "text").mapInArrow(lean(run), kinds)


def upper_bound(k: int, n: int, error: float) -> float:
    """Clopper-Pearson: the rate at which k or fewer of n happen with probability ``error``."""
    if k >= n:
        return 1.0

    def tail(p: float) -> float:  # P(X <= k), summed from logarithms
        if p <= 0:
            return 1.0
        logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
        top = max(logs)
        return math.exp(top) * sum(math.exp(x - top) for x in logs)

    low, high = k / n, 1.0 - 1e-12
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if tail(mid) > error else (low, mid)
    return high


def needed(risk: float, error: float) -> int:
    """Good rows from which on a level that rejects none of them is certified."""
    return math.ceil(math.log(error) / math.log1p(-risk))


def choose(good: list[int], poor: list[int], n_good: int, risk: float, error: float) -> int | None:
    """Index of the level to hold, given the good and poor rows that each rejects, lenient first; None if the rules stay off."""
    certified = -1
    for i, k in enumerate(good):
        if not n_good or k > risk * n_good or upper_bound(k, n_good, error) > risk:
            break
        certified = i
    if certified < 0 or not poor[certified]:
        return None
    return next(i for i in range(certified + 1) if poor[i] >= poor[certified])


def cutoffs(labelled: DataFrame, risk: float = 0.02, delta: float = 0.05) -> dict[str | None, dict[str, float]]:
    """Certified cutoffs by stratum and rule, of rows with MEASURES, stratum, quality (1 good, 0 poor) and text_hash.

    The driver receives quantiles and counts by stratum and level only. Quantiles are Spark's approximate
    ones: a level may be any fixed vector, as the other half certifies it.
    """
    names = list(rules())
    rows = labelled.where("quality in (0, 1)").select("stratum", "text_hash", "quality", *(v.alias(k) for k, v in rules().items())).dropDuplicates(["stratum", "text_hash", "quality"])
    rows = rows.withColumn("half", F.pmod(F.xxhash64("text_hash", F.lit("half")), F.lit(2)))
    sizes = {r["stratum"]: r["n"] for r in rows.where("quality = 1 and half = 1").groupBy("stratum").agg(F.count("*").alias("n")).collect()}
    large = {s for s, n in sizes.items() if n >= 4 * needed(risk, delta / (len(sizes) + 1))}
    pooled = set(sizes) - large
    if not sizes:
        return {}
    # pooled strata have the name null here; a null language among the large ones is told apart by "apart"
    apart = reduce(lambda a, b: a | b, (F.col("stratum").eqNullSafe(F.lit(s)) for s in large), F.lit(False))
    rows = rows.withColumns({"apart": apart, "stratum": F.when(apart, F.col("stratum"))})
    shares = [1 - x for x in LEVELS]
    marks = rows.where("quality = 1 and half = 0").groupBy("apart", "stratum").agg(*(F.percentile_approx(F.col(x), shares, 10_000).alias(x) for x in names)).collect()
    levels = {(r["apart"], r["stratum"]): [*({x: r[x][0] * f for x in names} for f in FACTORS), *({x: r[x][i] for x in names} for i in range(len(LEVELS)))] for r in marks}
    if not levels:
        return {}
    # every stratum's counts in one aggregate: its levels' cutoffs stand beside its rows
    held = [(own, stratum, [[float(v[x]) for x in names] for v in vectors]) for (own, stratum), vectors in levels.items()]
    table = rows.sparkSession.createDataFrame(held, "own boolean, of string, v array<array<double>>")
    if len(held) <= BROADCAST_STRATA:
        table = F.broadcast(table)
    met = rows.join(table, (F.col("apart") == F.col("own")) & F.col("stratum").eqNullSafe(F.col("of")))
    tested, poor = (F.col("quality") == 1) & (F.col("half") == 1), F.col("quality") == 0
    beyond = [reduce(lambda a, b: a | b, (F.col(x) > F.col("v")[i][j] for j, x in enumerate(names))) for i in range(len(FACTORS) + len(LEVELS))]
    counts = met.groupBy("own", "of").agg(F.count_if(tested).alias("n"), *(F.count_if(side & x).alias(f"{k}{i}") for k, side in (("good", tested), ("poor", poor)) for i, x in enumerate(beyond)))
    out: dict[str | None, dict[str, float]] = {}
    for r in counts.collect():
        vectors = levels[r["own"], r["of"]]
        good, bad = ([r[f"{k}{i}"] for i in range(len(vectors))] for k in ("good", "poor"))
        at = choose(good, bad, r["n"], risk, delta / (len(large) + bool(pooled)))
        if at is not None:
            for s in ([r["of"]] if r["own"] else pooled):
                out[s] = vectors[at]
    return out


def verdicts(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """MEASURES, base_failed, rejected_by (the first rule that rejects) and kept of docs(doc_id, text, lang).

    labels(doc_id, quality) are the labelled rows.
    """
    tables = Tables(docs.sparkSession, "quality")
    strata = docs.select(F.col("doc_id").cast("long"), F.col("lang").alias("stratum"), F.xxhash64("text").alias("text_hash"), "text")
    found = tables.put(measures(strata), "measures")
    known = labels.where("doc_id is not null and quality is not null").select(F.col("doc_id").alias("labelled"), "quality").distinct()
    cut = cutoffs(found.join(known, F.col("doc_id") == F.col("labelled")), **settings)
    rejected = F.lit(None).cast("string")
    for name, value in reversed(rules().items()):
        # one condition a rule: the map has the strata's cutoffs, a null language apart
        named = [x for s, v in cut.items() if s is not None for x in (F.lit(s), F.lit(float(v[name])))]
        limit = F.create_map(*named)[F.col("stratum")] if named else F.lit(None).cast("double")
        limit = F.when(F.col("stratum").isNull(), F.lit(float(cut[None][name])) if None in cut else F.lit(None).cast("double")).otherwise(limit)
        rejected = F.when(value > limit, F.lit(name)).otherwise(rejected)
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    out = found.withColumn("base_failed", base).withColumn("rejected_by", rejected).drop("text_hash")
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull())
