"""Document fingerprints by one-permutation MinHash.

Every word shingle of a text is hashed once; its hash's high bits choose one of ``bins`` bins, and a bin
keeps its least hash. An empty bin takes the value of the first filled one in a fixed random order of its
own (optimal densification). Of each value the low ``bits`` bits of another hash are kept, packed into a
hex string. Two fingerprints' share of equal bins, corrected for values that agree by chance, estimates
the Jaccard similarity of the shingle sets.

successors() gives each document the next one in ascending doc_id order without a global sort: documents
go to doc_id ranges once, and the first document of every range also to the range before it.

Rows: a null text is empty; a text without words has the empty fingerprint, like 1 to another such and 0
to any other. Null doc_ids come first; repeated ones stand in text order. The only document follows itself.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, partitions
from .text import U, chunks, flat, mix, shingle_sets

_LEAST = -(1 << 63)


@dataclass(frozen=True)
class Sketch:
    """``bins`` a power of two, ``bits`` 1, 2, 4 or 8, shingles of ``words`` words."""

    bins: int = 256
    bits: int = 4
    words: int = 5

    def codes(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(texts, bins) values of ``bits`` bits, and which texts have words."""
        buf, at = flat(texts)
        rows, some = [np.zeros((0, self.bins), np.uint8)], [np.zeros(0, bool)]
        for _, _, own, own_at in chunks(buf, at):
            h, offsets = shingle_sets(own, own_at, self.words)
            n = len(offsets) - 1
            cell = np.repeat(np.arange(n), np.diff(offsets)) * self.bins + (h >> U(65 - self.bins.bit_length())).astype(np.int64)
            first = np.ones(len(cell), bool)
            first[1:] = cell[1:] != cell[:-1]  # hashes ascend in a text, so a bin's first is its least
            code, full = np.zeros(n * self.bins, np.uint8), np.zeros(n * self.bins, bool)
            code[cell[first]] = (mix(h[first] ^ U(0xA5A5A5A5)) & U((1 << self.bits) - 1)).astype(np.uint8)
            full[cell[first]] = True
            some.append(np.diff(offsets) > 0)
            todo = np.flatnonzero(~full & np.repeat(some[-1], self.bins))
            turn = 0
            while len(todo):
                bin_ = todo % self.bins
                other = todo - bin_ + (mix(bin_.astype(U) * U(0x1000003) + U(turn)) & U(self.bins - 1)).astype(np.int64)
                found = full[other]
                code[todo[found]] = code[other[found]]
                todo, turn = todo[~found], turn + 1
            rows.append(code.reshape(n, self.bins))
        return np.concatenate(rows), np.concatenate(some)

    def hex(self, codes: np.ndarray, some: np.ndarray) -> list[str]:
        per = 8 // self.bits
        packed = np.zeros((len(codes), self.bins // per), np.uint8)
        for i in range(per):
            packed |= codes[:, i::per] << np.uint8(self.bits * i)
        return [row.tobytes().hex() if s else "" for row, s in zip(packed, some, strict=True)]

    def likeness(self, a: np.ndarray, a_some: np.ndarray, b: np.ndarray, b_some: np.ndarray) -> np.ndarray:
        chance = 2.0**-self.bits
        near = np.clip(((a == b).mean(axis=1) - chance) / (1 - chance), 0, 1)
        return np.where(a_some & b_some, near, (a_some == b_some).astype(float))


def successors(docs: DataFrame) -> DataFrame:
    """(range, doc_id, text, ahead) of docs(doc_id, text), in partitions sorted by range and order.

    In a range, each row follows the one before it; the first row that is ``ahead`` of the range follows
    its last one. Sixteen small ranges a partition are cut by rows, and joined to ranges of about equal bytes.
    """
    parts = partitions(docs.sparkSession)
    key = F.coalesce(F.col("doc_id"), F.lit(_LEAST))
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    fine = 16 * parts
    cuts = np.unique(rows.select("doc_id").approxQuantile("doc_id", [i / fine for i in range(1, fine)], 0.25 / fine) or [0.0])

    @F.pandas_udf("int")
    def small_range_of(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, k.to_numpy(), "right").astype(np.int32))

    small = rows.select(key.alias("k"), F.octet_length("text").alias("size")).withColumn("range", small_range_of("k"))
    small = sorted(tuple(r) for r in small.groupBy("range").agg(F.min("k"), F.sum("size") + F.count("*")).collect())  # a row a small range
    share = np.cumsum([n for _, _, n in small]) / max(1, sum(n for _, _, n in small))
    home, of_small = 0, np.zeros(len(cuts) + 1, np.int32)
    for i, (place, _, _) in enumerate(small):
        home = max(home, int((share[i - 1] if i else 0.0) * parts))
        of_small[place] = home

    @F.pandas_udf("int")
    def range_of(k: pd.Series) -> pd.Series:
        return pd.Series(of_small[np.searchsorted(cuts, k.to_numpy(), "right")])

    firsts: list[tuple[int, int]] = []
    for place, k, _ in small:
        if not firsts or firsts[-1][0] != of_small[place]:
            firsts.append((int(of_small[place]), k))  # one row a range
    first_keys = np.array([k for _, k in firsts], np.int64)
    before = np.array([firsts[i - 1][0] for i in range(len(firsts))], np.int32)

    @F.pandas_udf("int")
    def also_in(k: pd.Series) -> pd.Series:
        own = k.to_numpy()
        at = np.minimum(np.searchsorted(first_keys, own), max(len(first_keys) - 1, 0))
        return pd.Series(np.where(first_keys[at] == own, before[at], -1).astype(np.int32))

    where = F.array(F.struct(range_of("k").alias("range"), F.lit(False).alias("ahead")), F.struct(also_in("k").alias("range"), F.lit(True).alias("ahead")))
    return (
        rows.withColumn("k", key).withColumn("x", F.explode(F.filter(where, lambda x: x["range"] >= 0)))
        .select("x.range", "k", "doc_id", "text", "x.ahead")
        .repartition(parts, "range").sortWithinPartitions("range", "ahead", "k", "text").drop("k")
    )


def compare_edited(docs: DataFrame, sketch: Sketch = Sketch()) -> DataFrame:
    """Fingerprints of each text and of its edit, in which the last half has become the next text's first.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)
    """

    def run(batches):
        kept = None
        for b in batches:
            table = pa.Table.from_batches([b] if kept is None else [kept, b]).combine_chunks()
            rng, ahead = table["range"].to_numpy(), table["ahead"].to_numpy()
            n = len(rng)
            if not n:
                continue
            kept = table.slice(n - 1).to_batches()[0]
            cur = np.flatnonzero(~ahead[:-1] & (rng[:-1] == rng[1:]))
            if not len(cur):
                continue
            texts = table["text"].to_pylist()
            edited, sizes, shas = [], [], []
            for i in cur.tolist():
                t = texts[i]
                half = len(t) // 2
                e = t[: len(t) - half] + texts[i + 1][:half]
                edited.append(e)
                sizes.append(len(t))
                shas.append(hashlib.sha256(e.encode()).hexdigest())
            own, some = sketch.codes(table["text"].combine_chunks())
            new, new_some = sketch.codes(pa.array(edited, pa.large_string()))
            yield pa.RecordBatch.from_arrays(
                [
                    table["doc_id"].combine_chunks().take(pa.array(cur)), pa.array(sizes, pa.int64()), pa.array(shas),
                    pa.array(sketch.hex(own[cur], some[cur])), pa.array(sketch.hex(new, new_some)),
                    pa.array(sketch.likeness(own[cur], some[cur], new, new_some)), pa.array(sketch.likeness(own[cur], some[cur], own[cur + 1], some[cur + 1])),
                ],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    kinds = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return successors(docs).mapInArrow(lean(run), kinds)


def fingerprints(docs: DataFrame, sketch: Sketch = Sketch()) -> DataFrame:
    """(doc_id, fingerprint) of every row of docs(doc_id, text)."""

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(sketch.hex(*sketch.codes(b["text"])), pa.string())], ["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fingerprint string")
