import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import negatives, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, positives=5, negatives=5, num=80, den=100, scale=256, every=100):
    own = []
    for i, x, label in rows:
        if i is None or label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        q = [math.floor(float(np.float32(v)) * scale) for v in x]
        if sum(v * v for v in q) < 2**62:
            own.append((i, q, label))
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for i, q, label in own:
        if i % every:
            continue
        ranked = sorted((-score(q, r), j, other) for j, r, other in own if j != i)
        for p, j, _ in [x for x in ranked if x[2] == label][:positives]:
            window = [x for x in ranked if x[2] != label and num * -p <= den * -x[0] <= den * -p][:negatives]
            out += [(i, j, k, n[1], -p, -n[0]) for k, n in enumerate(window, 1)]
    return sorted(out)


def found(spark, rows, parts=4, **options):
    table = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return sorted(tuple(r) for r in negatives.mine(table, F.col("vec_id") % 100 == 0, **options).collect())


def cloud(rng, n, dim, labels, step=1, spread=0.4):
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    return [(i * step, [float(np.float32(c + rng.gauss(0, spread))) for c in rng.choice(centres)], rng.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize(("n", "dim", "labels", "step"), [(700, 8, 3, 1), (300, 3, 2, 10), (150, 5, 40, 20)])
def test_against_brute_force(spark, n, dim, labels, step, monkeypatch):
    """Several trees a label, several blocks of anchors and groups of trees."""
    for name, value in (("TREE_ROWS", 40), ("LEAF_ROWS", 7), ("BLOCK", 3), ("GROUP", 2)):
        monkeypatch.setattr(negatives, name, value)
    rows = cloud(random.Random(n), n, dim, labels, step)
    want = brute(rows)
    assert want and found(spark, rows) == want


def test_ties_repeats_and_odd_rows(spark):
    rng = random.Random(2)
    rows = [(i, [float(rng.randint(-1, 1)) / 16 for _ in range(3)], rng.randrange(2)) for i in range(400)]
    rows += rows[:120]  # rows with the same vec_id
    rows += [(1000, None, 1), (1001, [1.0, None, 0.0], 1), (1100, [1.0, math.nan, 0.0], 1), (1200, [math.inf, 0.0, 0.0], 0), (1300, [1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0], 1)]
    rows += [(1400, [], 1), (1500, [0.5], 0), (1501, [0.5, 0.5, 0.5, 0.5], 1), (-100, [0.25, 0.5, 0.0], 1)]
    assert found(spark, rows) == brute(rows)


def test_large_components_stay_exact(spark):
    rng = random.Random(4)
    rows = [(i * 25, [float(np.float32(rng.uniform(0.2, 1) * 2.0**20)) for _ in range(6)], i % 3) for i in range(80)]
    rows += [(5000, [3e38, 1.0], 0), (5100, [2.0**24, 0.0], 0)]
    assert found(spark, rows) == brute(rows)


def test_hot_vector_and_hot_label(spark):
    rows = cloud(random.Random(9), 300, 4, 5) + [(1000 + i, [0.5, 0.25, -0.5, 0.125], 1 if i % 3 else 2) for i in range(300)]
    assert found(spark, rows, positives=3, negatives=2, share=(1, 2)) == brute(rows, 3, 2, 1, 2)


def test_nothing_to_find(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0], 0), (2, [1.0], 1)]) == []  # no anchor
    assert found(spark, [(100, [1.0], 0), (2, [1.0], 1)]) == []  # no positive
    assert found(spark, [(100, [1.0], 0), (2, [1.0], 0)]) == []  # no negative
    assert found(spark, [(100, [1.0], 0), (2, [-1.0], 0), (3, [-1.0], 1)]) == []  # a negative positive's window is empty


def test_extra_columns_are_ignored(spark):
    rows = cloud(random.Random(1), 200, 4, 2)
    table = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(7) for c in ("rank", "score", "tree", "window", "anchor_id", "cell", "group")})
    assert sorted(tuple(r) for r in negatives.mine(table, F.col("vec_id") % 100 == 0).collect()) == brute(rows)


def test_balls_hold_their_rows_and_bound_scores():
    rng = np.random.default_rng(3)
    v = rng.integers(-300, 300, (500, 7))
    order, centres, radii, spans = negatives.build(v)
    assert sorted(order) == list(range(500))
    anchors = rng.integers(-300, 300, (9, 7))
    search = negatives.Search(np.arange(9), anchors, np.zeros((9, 1), np.int64), np.zeros((9, 1), np.int64), 1)
    tree = type("T", (), {"centres": centres, "radii": radii})
    for node, (start, end, left, right) in enumerate(spans):
        scores = anchors @ v[order[start:end]].T
        lower, upper = search.bounds(tree, node, np.arange(9))
        assert (scores >= lower[:, None]).all() and (scores <= upper[:, None]).all()
        if left >= 0:
            assert spans[left][0] == start and spans[left][1] == spans[right][0] and spans[right][1] == end


def test_branches_are_pruned():
    """Over clustered vectors most rows are never scored, yet the first ones are those of brute force."""
    rng = np.random.default_rng(8)
    centres = rng.normal(0, 300, (40, 12))
    v = np.floor(centres[rng.integers(0, 40, 6000)] + rng.normal(0, 12, (6000, 12))).astype(np.int64)
    order, c, radii, spans = negatives.build(v)
    row = {"label": 1, "dim": 12, "ids": order.astype(np.int64).tobytes(), "kind": "int64", "vectors": v[order].tobytes(), "centres": c.tobytes(), "radii": radii.tobytes(), "spans": spans.tobytes()}
    ids = np.arange(50)
    limits = np.full((50, 1), -(2**63)), np.full((50, 1), 2**63 - 1)
    search = negatives.Search(ids, v[:50], *limits, 5)
    search.visit(negatives.Tree(row, 12), ids)
    for a in range(50):
        scores = v @ v[a]
        want = [i for i in np.lexsort((np.arange(6000), -scores)) if i != a][:5]
        assert search.found[search.at == a].tolist() == want
    assert search.scored < 0.25 * 50 * 6000
    windowed = negatives.Search(ids, v[:50], np.full((50, 1), 10**9), np.full((50, 1), 2 * 10**9), 5)
    windowed.visit(negatives.Tree(row, 12), ids)
    assert windowed.scored == 0


def test_query_as_registered(spark):
    path = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    got = queries.op11_hard_negatives(spark, path)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]
