import random

import numpy as np
import pytest

from tallyforge.llm import mixing

TOXIC = ["grr", "zzt", "brk"]


def table(n=900, seed=2):
    rng, rows, labels = random.Random(seed), [], []
    plain = [f"w{i}" for i in range(60)]
    for i in range(n):
        toxic = i % 5 == 0
        words = rng.choices(plain, k=rng.randint(20, 60))
        if toxic:
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(TOXIC)
        rows.append((i, " ".join(words)))
        if i % 2:
            labels.append((i, "toxic" if toxic else "good"))
    return rows, labels


@pytest.fixture(scope="module")
def rated(spark, documents):
    rows, labels = table()
    known = spark.createDataFrame(labels, "doc_id long, domain string")
    return rows, mixing.rates(documents(rows), known, targets={"toxic": 0.0}).collect()


def test_toxic_goes_clean_stays(rated):
    rows, got = rated
    toxic = {i for i, t in rows if set(t.split()) & set(TOXIC)}
    assert {r["doc_id"] for r in got if r["rate"] < 0.5} == toxic
    assert all(r["rate"] >= 0 and abs(sum(r["posterior"]) - 1) < 1e-9 for r in got)
    assert all(r["n_tokens"] == len(dict(rows)[r["doc_id"]].split()) for r in got)


def test_rates_are_the_least_squares_solution(spark):
    rng = np.random.default_rng(0)
    p, t = rng.dirichlet([1, 1, 1], 60), rng.integers(1, 50, 60)
    members = spark.createDataFrame([(int(n), x.tolist()) for n, x in zip(t, p)], "n_tokens long, posterior array<double>").repartition(4)
    goal, pull = np.array([0.6, 0.1, 0.3]), 20.0
    rate = mixing._rate(p, mixing.fit_rates(members, goal, pull, rounds=300, tolerance=1e-9), pull)[0]
    share = t / t.sum()
    r = np.ones(60)
    for _ in range(20_000):  # plain projected gradient to the end
        r = np.maximum(0, r - (p @ (pull * ((r * share) @ p - goal)) + r - 1) / (1 + pull))
    assert np.abs(rate - r).max() < 1e-4


def test_targets_are_met(spark, documents):
    rows, labels = table()
    got = mixing.rates(documents(rows), spark.createDataFrame(labels, "doc_id long, domain string"), targets={"good": 0.5, "toxic": 0.5}, pull=500.0).collect()
    t = np.array([r["n_tokens"] for r in got])
    total = (np.array([r["posterior"] for r in got]) * (t * np.array([r["rate"] for r in got]))[:, None]).sum(0) / t.sum()
    assert np.abs(total - 0.5).max() < 0.02


def test_odd_rows(spark, documents, odd):
    labels = spark.createDataFrame([(4, "good"), (6, "poor"), (None, "good"), (77, "poor"), (8, None)], "doc_id long, domain string")
    for known in (labels, labels.where("false")):
        got = mixing.rates(documents(odd), known, mark="m_", keep_text=True).collect()
        assert sorted((r["doc_id"] or 0, r["text"] or "") for r in got) == sorted((i or 0, t or "") for i, t in odd)
        assert all(r["m_rate"] >= 0 for r in got)
    assert mixing.rates(documents(odd).where("false"), labels).count() == 0
    with pytest.raises(ValueError, match="rate"):
        mixing.rates(documents(odd).withColumnRenamed("source", "Rate"), labels)


@pytest.mark.parametrize("every", [10, 100, 1000])
def test_rare_toxic_goes(spark, documents, tmp_path, every):
    """The pipeline's stage at 10%, 1% and 0.1% toxic documents."""
    import corpus_pipeline

    rng, rows, labels = random.Random(every), [], []
    for i in range(10_000):
        words = rng.choices([f"w{k}" for k in range(60)], k=rng.randint(10, 30))
        if i % every == 0:
            words += TOXIC * 2
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % every > 0), int(i % every == 0)))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.mixed(spark, documents(rows), str(tmp_path)).select("doc_id").collect()}
    assert kept == {i for i in range(10_000) if i % every}


def test_rare_domain_meets_its_target(spark, documents, tmp_path):
    """The registered query, with its own parameters, where poor and toxic documents are rare."""
    from tallyforge.llm import queries

    rng, rows, labels = random.Random(4), [], []
    for i in range(3000):
        poor, toxic = i % 50 == 1, i % 50 == 2
        own = TOXIC if toxic else ["hm", "uh", "er"] if poor else [f"w{k}" for k in range(60)]
        rows.append((i, " ".join(rng.choices(own, k=40))))
        labels.append((i, int(not poor), int(toxic)))
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = queries.op10_mixing(spark, str(tmp_path))
    got = found.collect()
    by = lambda weigh: {d: sum(weigh(r) for r in got if r["domain"] == d) / 120_000 for d in ("good", "poor", "toxic")}
    share, total = by(lambda r: r["n_tokens"]), by(lambda r: r["n_tokens"] * r["rate"])
    for d, target in (("good", 0.8), ("poor", 0.1), ("toxic", 0.0)):
        assert abs(total[d] - target) <= abs(share[d] - target) * 0.05 + 1e-3, (d, share, total)
        assert np.allclose(found.tallyforge_totals[d], (share[d], target, total[d]), atol=3e-3)


def test_domains_are_not_dropped(spark, documents):
    docs = documents([(i, f"word {i}") for i in range(300)])
    many = spark.createDataFrame([(i, f"d{i}") for i in range(300)], "doc_id long, domain string")
    with pytest.raises(ValueError, match="more than 250"):
        mixing.rates(docs, many)
    with pytest.raises(ValueError, match="targets"):
        mixing.rates(docs, many.where("doc_id < 9"), targets={"d1": 0.5, "other": 0.5})
    rare = spark.createDataFrame([(i, "rare" if i == 7 else "common") for i in range(300)], "doc_id long, domain string")
    assert mixing.fit(docs, rare, sample=20).domains == ("common", "rare")
