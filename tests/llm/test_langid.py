import math
import random
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import langid

WORDS = {"aa": "bado kiru lomi tesa nupo", "bb": "xyzzt qwrrt plmmk zzxyq vvbnk"}


def corpus(n=240):
    rng = random.Random(1)
    return [(i, " ".join("".join(rng.sample(w, len(w))) if rng.random() < 0.1 else w for w in rng.choices(WORDS[x].split(), k=rng.randint(3, 30))), x) for i, x in ((i, ("aa", "bb")[i % 2]) for i in range(n))]


def brute_model(texts, order):
    """Interpolated Kneser-Ney probabilities by the definition, of one language."""
    grams = [Counter() for _ in range(order + 1)]
    for t in texts:
        for w in langid._words_of(t):
            p = langid.START * (order - 1) + w + langid.END
            grams[order].update(p[i : i + order] for i in range(len(p) - order + 1))
    for k in range(order - 1, 0, -1):
        grams[k] = Counter(g[1:] for g in grams[k + 1])
    discount = [0.5] * (order + 1)
    for k in range(1, order + 1):
        one, two = (sum(v == i for v in grams[k].values()) for i in (1, 2))
        discount[k] = min(0.9, max(0.1, one / (one + 2 * two))) if one + two else 0.5
    total, kinds = defaultdict(int), defaultdict(int)
    for k in range(1, order + 1):
        for g, n in grams[k].items():
            total[k, g[:-1]] += n
            kinds[k, g[:-1]] += 1

    def p(context, c, alphabet):
        value = 1 / alphabet
        for k in range(1, order + 1):
            h = context[len(context) - k + 1 :]
            if (k, h) in total:
                value = max(grams[k][h + c] - discount[k], 0) / total[k, h] + discount[k] * kinds[k, h] / total[k, h] * value
        return value

    return p


def test_scores_are_those_of_the_definition(spark, documents):
    rows = corpus()
    docs = documents(rows)
    model = langid.fit(docs, per_language=10**6, calibrate=1, order=3)
    roll = docs.where(langid.is_training(F.col("doc_id"))).collect()
    alphabet = round(math.exp(-model.floor))
    used = {x: [r["text"] for r in roll if r["lang"] == x] for x in model.langs}
    words = ["bado", "xyq", "é", "lomixyz"]
    got, size = langid.score_words(model, words)
    for j, lang in enumerate(model.langs):
        p = brute_model(used[lang], 3)
        for w, row, n in zip(words, got, size):
            padded = langid.START * 2 + w + langid.END
            want = sum(math.log(p(padded[i - 2 : i], padded[i], alphabet)) for i in range(2, len(padded)))
            assert n == len(w) + 1 and abs(row[j] - want) < 1e-3


def test_held_out_accuracy_and_rejection(spark, documents):
    docs = documents([*corpus(6000), (10_001, "bado kiru lomi tesa", None), (10_002, "ЖЩЮ ЯЫЪ ЙЦУ " * 40, None)])
    model = langid.fit(docs, per_language=1000, calibrate=1000)
    assert np.isfinite(model.limit).all()
    got = {r["doc_id"]: r for r in langid.predict(docs, model).collect()}
    held = [r for r in got.values() if r["lang"] and r["doc_id"] < 10_000]
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.99
    assert np.mean([r["rejected"] for r in held]) < 0.01
    assert got[10_001]["lang_pred"] == "aa" and not got[10_001]["rejected"] and got[10_002]["rejected"]


def test_odd_rows(spark, documents, odd):
    docs = documents([*corpus(60), *((i if i is None else i + 1000 if i < 2**60 else i, t) for i, t in odd)]).withColumn("score_", F.lit(1))
    for model in (langid.fit(docs), None):
        got = langid.predict(docs, model)
        rows = got.collect()
        assert len(rows) == 60 + len(odd) and "score_" in got.columns
        for r in rows:
            assert 0 <= r["score"] <= 1
            if not any(unicodedata.category(c)[0] == "L" for c in r["text"] or ""):
                assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0, True)
    empty = docs.where("false")
    assert langid.fit(empty) is None and langid.predict(empty, langid.fit(docs)).count() == 0


def test_signs_and_numbers_are_no_letters(spark, documents):
    model = langid.fit(documents(corpus(60)))
    rows = [(1, "½ ² ① Ⅷ ٣"), (2, "bado²"), (3, "_ 12"), (4, "bado kiru " * 100_000), (5, "bado" * 300_000)]
    got = {r["doc_id"]: r for r in langid.predict(documents(rows), model).collect()}
    assert [got[i]["lang_pred"] for i in range(1, 6)] == ["und", "aa", "und", "aa", "aa"]
    with pytest.raises(ValueError, match="score"):
        langid.predict(documents(rows).withColumn("Score", F.lit(1)), model)


def test_limits_are_conformal():
    """A language's own texts of any length are rejected at the rate alpha; with too few there is no limit."""
    rng = np.random.default_rng(0)
    chars = rng.integers(5, 5000, 22_000).astype(float)
    made = pd.DataFrame({"lang": np.repeat(["a", "b"], 11_000), "chars": chars, "entropy": 2 + rng.normal(size=22_000) * np.sqrt(0.01 + 4 / chars)})
    blank = langid.LanguageModel(("a", "b", "c"), 1, 0.0, np.zeros(3), (), (), (), np.zeros(3), (1.0, 0.0), np.full(3, np.inf))
    fitted = langid._calibrated(blank, made.iloc[[*range(1000), *range(11_000, 11_400)]], 0.01)
    assert np.isfinite(fitted.limit).tolist() == [True, True, False]
    rest = made.iloc[1000:11_000]
    for some in (rest, rest[rest.chars < 100]):
        assert langid.reject(fitted, some.entropy.to_numpy(), np.zeros(len(some), int), some.chars.to_numpy()).mean() < 0.03
    assert 0.003 < langid.reject(fitted, rest.entropy.to_numpy(), np.zeros(len(rest), int), rest.chars.to_numpy()).mean()
    assert np.isinf(langid._calibrated(blank, made.iloc[:90], 0.01).limit).all()
