import hashlib
import random

import numpy as np
import pyarrow as pa

from tallyforge.llm.fingerprint import Sketch, compare_edited, fingerprints

SKETCH = Sketch()


def test_estimates():
    rng, errors = random.Random(1), []
    for _ in range(150):
        a = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(60, 400))]
        cut = rng.randint(0, len(a))
        b = a[:cut] + [f"v{rng.randrange(10**6)}" for _ in range(len(a) - cut)]
        x, y = ({tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in (a, b))
        codes, some = SKETCH.codes(pa.array([" ".join(a), " ".join(b)]))
        errors.append(SKETCH.likeness(codes[:1], some[:1], codes[1:], some[1:])[0] - len(x & y) / len(x | y))
    assert abs(np.mean(errors)) < 0.01 and np.abs(errors).max() < 0.15  # unbiased; three to four standard errors


def test_sparse_sets_fill_all_bins():
    codes, some = SKETCH.codes(pa.array(["one", "one two three four five six", "", None]))
    assert some.tolist() == [True, True, False, False] and len(set(codes[0])) == 1 and len(set(codes[1])) <= 2
    assert SKETCH.hex(codes, some)[2:] == ["", ""] and len(SKETCH.hex(codes, some)[0]) == 256
    assert SKETCH.likeness(codes[2:3], some[2:3], codes[3:], some[3:])[0] == 1
    assert SKETCH.likeness(codes[:1], some[:1], codes[3:], some[3:])[0] == 0


def test_next_document_and_edit(spark, documents, odd):
    rows = [*odd, *((100 + 3 * i, f"text {i} " * (i % 7)) for i in range(200))]
    got = compare_edited(documents(rows, 7)).collect()
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    want = []
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        half = len(t) // 2
        want.append((i, len(t), hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()))
    key = lambda r: (r[0] or 0, r[1], r[2])
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=key) == sorted(want, key=key)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    own = {(r["doc_id"], r["fingerprint"]) for r in fingerprints(documents(rows)).collect()}
    assert {(r["doc_id"], r["fingerprint"]) for r in got} == own
    assert compare_edited(documents(rows).where("false")).count() == 0
    alone = compare_edited(documents([(3, "a b c d e f g h")])).collect()
    assert [(r["doc_id"], r["near_next"]) for r in alone] == [(3, 1.0)]
