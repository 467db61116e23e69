import collections
import random
import re

import pytest

from tallyforge.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(t):
    t = t or ""
    w = WORD.findall(t)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    count, cover, seen, copies = collections.Counter(windows), set(), set(), 0
    for i, x in enumerate(windows):
        if count[x] > 1:
            cover |= set(range(i, i + 5))
    for x in t.split("\n"):
        if WORD.search(x):
            copies += x in seen
            seen.add(x)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), copies, len(cover)


def test_measures(spark, documents, odd):
    rng = random.Random(1)
    rows = [*odd, *((100 + i, "".join(rng.choices("ab é#|\n\t  ", k=rng.randint(0, 120)))) for i in range(300))]
    names = quality.MEASURES[:5]
    got = sorted((r["doc_id"] or 0, *(r[n] for n in names)) for r in quality.measures(documents(rows).select("doc_id", "text")).collect())
    assert got == sorted((i or 0, *brute(t)) for i, t in rows)


def test_upper_bound_is_exact():
    from math import comb

    for k, n, error in ((0, 50, 0.05), (3, 200, 0.01), (7, 40, 0.2)):
        p = quality.upper_bound(k, n, error)
        assert abs(sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)) - error) < 1e-6
    assert quality.upper_bound(5, 5, 0.1) == 1


def test_choice():
    assert quality.choose([0, 0, 3, 40], [0, 9, 10, 90], 2000, 0.01, 0.01) == 2
    assert quality.choose([0, 0, 3, 40], [0, 10, 10, 90], 2000, 0.01, 0.01) == 1
    assert quality.choose([0], [5], 20, 0.01, 0.01) is None  # too few good rows to certify
    assert quality.choose([0, 0], [0, 0], 2000, 0.01, 0.01) is None
    for risk, error in ((0.02, 0.05), (0.005, 0.01)):
        n = quality.needed(risk, error)
        assert quality.upper_bound(0, n, error) <= risk < quality.upper_bound(0, n - 1, error)


def test_joint_false_rejections_stay_under_the_risk():
    """Over many labelled tables the true joint rate of the chosen level exceeds the risk in at most a share delta."""
    import numpy as np

    rng, bad = np.random.default_rng(3), 0
    everyone = rng.random((200_000, 5))
    for _ in range(200):
        good, poor = rng.random((1600, 5)), rng.random((300, 5)) * 0.5 + 0.5
        levels = [np.quantile(good[:800], 1 - x, axis=0) for x in quality.LEVELS]
        counts = [[int((rows > v).any(axis=1).sum()) for v in levels] for rows in (good[800:], poor)]
        at = quality.choose(*counts, 800, 0.02, 0.05)
        bad += at is not None and (everyone > levels[at]).any(axis=1).mean() > 0.02
    assert bad / 200 <= 0.08


def test_verdicts(spark, documents):
    """A large stratum, two small ones that are pooled, and one of null; repeated texts and labels count once."""
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(3000):
        poor = i % 4 == 0
        lang = "en" if i < 1600 else ("de", "fr", None, "")[i // 4 % 4]
        rows.append((i, " ".join(f"w{rng.randrange(10**6)}" + ("###" if poor else "") for _ in range(20)), lang))
        if i % 3:
            labels += [(i, 0 if poor else 1)] * (1 + i % 2)
    known = spark.createDataFrame([*labels, (None, 1), (1, None)], "doc_id long, quality int")
    found = quality.verdicts(documents(rows), known, risk=0.03)
    got = found.collect()
    assert all(not r["kept"] for r in got if r["doc_id"] % 4 == 0)
    assert sum(not r["kept"] for r in got if r["doc_id"] % 4) <= 0.03 * 2250
    assert "text_hash" not in found.columns
    few = spark.createDataFrame(labels[:40], "doc_id long, quality int")
    for table in (known.where("false"), few):
        off = quality.verdicts(documents(rows), table).collect()
        assert all(r["kept"] and r["rejected_by"] is None for r in off)


@pytest.mark.parametrize("labels", [[], [(4, 1), (4, 0), (None, 0)]])
def test_odd_rows(spark, documents, odd, labels):
    got = quality.verdicts(documents([(*x, None) for x in odd]), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]) and (not r["base_failed"] or not r["kept"])
    assert len(got) == len(odd)
    assert quality.verdicts(documents(odd).where("false"), spark.createDataFrame(labels, "doc_id long, quality int")).count() == 0
