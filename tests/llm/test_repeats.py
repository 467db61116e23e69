import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tallyforge.llm import queries, repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w, exponent=4, shortest=6):
    out = []
    for p in range(1, len(w) // exponent + 1):
        i = 0
        while i + p < len(w):
            if w[i] != w[i + p]:
                i += 1
                continue
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            x = w[i : j + p]
            if len(x) >= max(shortest, exponent * p) and not any(all(x[k] == x[k + q] for k in range(len(x) - q)) for q in range(1, p)):
                out.append((i, len(x), p))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_next_smaller(w):
    out = []
    for i in range(len(w)):
        j = next((j for j in range(i + 1, len(w)) if w[j:] < w[i:]), len(w))
        k = 0
        while j + k < len(w) and w[i + k] == w[j + k]:
            k += 1
        out.append((j, k))
    return out


def mixed(rng):
    w, n = [], rng.randint(1, 90)
    while len(w) < n:
        w += [rng.randrange(rng.choice((1, 2, 3, 9))) for _ in range(rng.randint(1, 6))] * rng.randint(1, 7)
    return w


@pytest.mark.parametrize(("letters", "most"), [(2, 11), (3, 7)])
def test_next_smaller_suffixes_of_all_short_words(letters, most):
    for n in range(1, most + 1):
        for w in itertools.product(range(letters), repeat=n):
            assert list(zip(*repeats.next_smaller(list(w)), strict=True)) == brute_next_smaller(w)


def test_runs_against_brute_force():
    rng = random.Random(12)
    for _ in range(1500):
        w = mixed(rng)
        assert repeats.runs_of(w) == brute(w)
        assert repeats.runs_of(w, 3, 5) == brute(w, 3, 5)


class Counted(int):
    """A number that counts how often it is compared."""

    seen = 0

    def __eq__(self, other):
        Counted.seen += 1
        return int(self) == int(other)

    __hash__ = int.__hash__


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize(
    "make",
    [fibonacci, lambda n: [bin(i).count("1") & 1 for i in range(n)], lambda n: [0] * n, lambda n: [0, 1] * (n // 2), lambda n: ([0] * (n // 8) + [1]) * 8, lambda n: list(range(n)), lambda n: list(range(n, 0, -1)), lambda n: (((([0] * 4 + [1]) * 4 + [2]) * 4 + [3]) * 4) * (n // 300)],
)
def test_comparisons_are_linear(make):
    for n in (3000, 30000):
        Counted.seen = 0
        repeats.next_smaller([Counted(x) for x in make(n)])
        assert Counted.seen <= 3 * n


def test_stretches_hold_all_runs():
    rng = random.Random(5)
    for _ in range(300):
        docs = [mixed(rng) if rng.random() < 0.6 else [rng.randrange(50) for _ in range(rng.randint(0, 60))] for _ in range(rng.randint(1, 8))]
        got = repeats.runs_of_texts(pa.array([" ".join(map(str, d)) for d in docs])).to_pydict()
        assert [[tuple(r.values()) for r in x] for x in got["runs"]] == [brute(d) for d in docs]


def test_ordinary_words_have_no_stretches():
    rng = np.random.default_rng(1)
    at = np.arange(0, 200_001, 200)
    starts, ends = repeats.stretches(rng.integers(0, 5000, 200_000).astype(np.int32), at)
    assert (ends - starts).sum() < 2000


def contract(doc_id, text):
    """The query's row by its contract."""
    w = WORD.findall(text or "")
    n = len(w)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    row = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return doc_id, len(runs), *row, digest("".join(f"{s},{length},{q}\n" for s, length, q in runs)), digest(" ".join(x for i, x in enumerate(w) if i not in gone))


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[6:]))


def test_query_as_registered(spark, documents, odd, tmp_path):
    rng = random.Random(3)
    rows = [*odd, (20, "a " * 50 + "b c b c b c b c b c"), (21, "a\x1cb a\x1cb\x0ba\x1cb a\x1cb\x0ca\x1cb a\x1cb"), (22, "a  b a  b a  b a  b"), (23, "a\x85 a\x85 a\x85 a\x85 a\x85 a")]
    rows += [(100 + i, rng.choice([" ", "\n", " \t"]).join(map(str, mixed(rng)))) for i in range(600)]
    documents(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r[c] for c in COLUMNS) for r in queries.op12_runs(spark, str(tmp_path)).collect()]
    assert by_id(got) == by_id(contract(*r) for r in rows)


def test_query_over_given_documents(spark):
    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    got = [tuple(r[c] for c in COLUMNS) for r in queries.op12_runs(spark, path).collect()]
    short = {r["doc_id"]: r["text"] for r in docs if len(r["text"] or "") < 4000}
    assert by_id(r for r in got if r[0] in short) == by_id(contract(*r) for r in short.items())
    assert len(got) == len(docs)


def test_extra_columns_and_empty_tables(spark, documents):
    docs = documents([(1, "x " * 9), (2, None)])
    got = {r["doc_id"]: r for r in repeats.find(docs).collect()}
    assert got[1]["lang"] == "en" and got[1]["collapsed"] == "x" and got[1]["runs"][0]["length"] == 9
    assert (got[2]["n_words"], got[2]["runs"], got[2]["collapsed"]) == (0, [], "")
    assert repeats.find(docs.where("false")).collect() == []
    from pyspark.sql import functions as F

    with pytest.raises(ValueError, match="runs"):
        repeats.find(docs.withColumn("RUNS", F.lit(1)))


def test_long_text(documents):
    period = [str(i) for i in range(70_000)]
    (row,) = repeats.find(documents([(1, " ".join(period * 4 + ["end"]))])).collect()
    assert [tuple(r) for r in row["runs"]] == [(0, 280_000, 70_000)]
    assert row["collapsed"] == " ".join([*period, "end"])
