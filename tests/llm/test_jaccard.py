import random
import re

import numpy as np
import pytest

from tallyforge.llm import jaccard
from tallyforge.llm.text import shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(rows, k, num, den):
    rows = [(i, shingles(t, k)) for i, t in rows if i is not None]
    up = {i: i for i, _ in rows}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, (i, x) in enumerate(rows):
        for j, y in rows[:a]:
            if x and y and den * len(x & y) >= num * len(x | y):
                p, q = find(i), find(j)
                up[max(p, q)] = min(p, q)
    return {i: find(i) for i in up}


def family(seed, n):
    """Texts of all sizes, with copies, near copies of any distance, a passage that many share."""
    rng, out = random.Random(seed), []
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=30)
    while len(out) < n:
        if out and rng.random() < 0.55:
            words = rng.choice(out).split(" ")
            for _ in range(rng.choice([0, 1, 1, 2, 4, 8])):
                at = rng.randrange(len(words) + 1)
                rng.choice([lambda: words.insert(at, rng.choice(vocabulary)), lambda: words.__delitem__(slice(at, at + 1)), lambda: words.__setitem__(slice(at, at + 1), [rng.choice(vocabulary).upper()])])()
        else:
            words = rng.choices(vocabulary, k=rng.choice([1, 3, 5, 8, 13, 20, 40, 90, 200]))
            if rng.random() < 0.4:
                words += passage
        out.append(" ".join(words))
    return list(enumerate(out))


@pytest.mark.parametrize("k, num, block", [(4, 85, 256), (5, 80, 4), (2, 60, 16), (3, 100, 256)])
def test_no_link_is_lost(spark, documents, k, num, block):
    rows = family(k, 250)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.classes(documents(rows, 6), k, num, 100, block).collect()}
    want = brute(rows, k, num, 100)
    assert got == {i: (len(shingles(t, k)), want[i]) for i, t in rows}


def test_blocking_is_whole():
    """Each linked pair shares a key, also for sets that leave parts empty."""
    rng = random.Random(3)
    for _ in range(400):
        n = rng.choice([1, 2, 5, 6, 7, 9, 12, 20, 60, 200])
        x = np.array([rng.getrandbits(64) for _ in range(n)], np.uint64)
        if rng.random() < 0.3:  # all elements in one corner of the hash space
            x >>= np.uint64(20)
        drop = rng.randrange(max(1, n // 5) + 1)
        y = np.concatenate([x[drop:], np.array([rng.getrandbits(64) for _ in range(rng.randrange(max(1, n // 6) + 1))], np.uint64)])
        x, y = np.unique(x), np.unique(y)
        both = len(np.intersect1d(x, y))
        if len(y) and 100 * both >= 80 * (len(x) + len(y) - both):
            keys, who = jaccard.block_keys(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]), 80, 100)
            assert set(keys[who == 0]) & set(keys[who == 1])


def test_tree_prunes_and_finds():
    rng = random.Random(5)
    sets = [np.unique(np.array([rng.getrandbits(64) for _ in range(rng.randint(5, 60))], np.uint64)) for _ in range(60)]
    sets += [np.unique(s[: max(1, len(s) - rng.randint(0, 3))]) for s in sets[:40]]
    marks = np.frombuffer(b"".join(jaccard._marks(s, 0, 512)[1] for s in sets), np.uint64).reshape(len(sets), -1)
    sizes, looked = np.array(list(map(len, sets))), []

    def linked(p, q):
        looked.append((p, q))
        both = len(np.intersect1d(sets[p], sets[q]))
        return 100 * both >= 80 * (len(sets[p]) + len(sets[q]) - both)

    found = jaccard.tree_links(jaccard.SignatureTree(sizes, sizes, marks), None, 80, 100, linked)
    want = sum(100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b)) for a, b in zip(sets[:40], sets[60:]))
    assert len(found) == want and len(looked) < len(sets) ** 2 / 20


def test_shingles_of_short_texts():
    import pyarrow as pa

    from tallyforge.llm.text import flat

    h, at = shingle_sets(*flat(pa.array([None, "", "a b", "A B", "a b c d", "b a"])), 3)
    assert np.diff(at).tolist() == [0, 0, 1, 1, 2, 1] and h[0] == h[1] and h[0] != h[-1]


def test_odd_rows(spark, documents, odd):
    got = jaccard.classes(documents(odd), 4, 85, 100).collect()
    assert len(got) == len(odd)
    want = brute([(i, t) for i, t in odd], 4, 85, 100)
    for r in got:
        assert r["component_id"] == (None if r["doc_id"] is None else want[r["doc_id"]])
    assert jaccard.classes(documents(odd).where("false")).count() == 0


def test_repeated_ids_join_their_classes(spark, documents):
    a, b, c = ("alpha beta gamma delta epsilon zeta " * 3, "one two three four five six seven " * 3, "red green blue black white grey " * 3)
    got = {r["component_id"] for r in jaccard.classes(documents([(1, a), (5, a), (5, b), (9, b), (7, c)]), 4, 85, 100).where("doc_id <> 7").collect()}
    assert got == {1}
