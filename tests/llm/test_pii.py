import random
import re

import pytest

from tallyforge.llm import pii


@pytest.fixture(scope="module")
def weights():
    rng = random.Random(7)
    return pii.train([pii._invented(rng) for _ in range(600)])


def brute(t):
    out = [(m.start(), m.end(), 0) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), m.end(), 1) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    for kind, pattern, few, many in ((2, r"[0-9]([\x20-]?[0-9])+", 12, 19), (3, r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, t):
            d = re.sub("[^0-9]", "", m.group())
            if few <= len(d) <= many and (kind == 3 or pii.luhn(d)):
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda x: (x[0], x[2]))


def test_base_spans():
    rng = random.Random(5)
    for _ in range(20_000):
        t = "".join(rng.choices("0123459..--  @@aB+()%é\n٣", k=rng.randint(0, 40)))
        assert pii.base_spans(t) == brute(t)
    assert len(pii.base_spans("0000000001.2.3.4 " + "1" * 200_000 + ".1..1 " + "a" * 200_000 + "@ " + "+1" + " " * 100_000)) == 1


def test_best_segmentation_is_the_best_of_all(weights):
    """The dynamic programme against all segmentations of short islands."""
    rng = random.Random(2)
    for _ in range(150):
        island = "".join(rng.choices("1234567 .@a+()-", k=14)).strip() or "1"
        n, ends, places = pii.candidates(island)

        def best(j, n=n, ends=ends):
            return 0.0 if j == 0 else max([best(j - 1), *(best(i) + sum(weights[x] for x in on) for i, _, on in ends[j])])

        spans = {(places.index(s), places.index(e), k) for s, e, k in pii.decode(island, weights)}
        value = sum(next(sum(weights[x] for x in on) for a, k2, on in ends[j] if (a, k2) == (i, k)) for i, j, k in spans)
        assert abs(value - best(n)) < 1e-9


def test_held_out_examples(weights):
    rng, right, total, found = random.Random(99), 0, 0, 0
    for _ in range(600):
        text, spans = pii._invented(rng)
        got = pii.decode(text, weights)
        right, total, found = right + len(set(got) & set(spans)), total + len(spans), found + len(got)
    assert right / total > 0.9 and right / found > 0.9


def test_field_adds_what_the_base_misses(weights):
    show = lambda t: [(pii.KINDS[k], t[s:e]) for s, e, k in pii.all_spans(t, weights, {})[1]]
    assert show("cards 4111111111111111 4012888888881881.") == [("card", "4111111111111111"), ("card", "4012888888881881")]
    assert show("call (659) 555-3949 now") == [("phone", "(659) 555-3949")]
    for clean in ("on 2024-01-05 at 12:30:00", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', "version 1.2.3", "1234567890123456", "in 1999", ""):
        assert show(clean) == []


def test_odd_rows(spark, documents, odd):
    docs = documents([*odd, (20, "é me@example.com 10.0.0.1"), (20, "é me@example.com 10.0.0.1")])
    rows = pii.find(docs, pii.fit(docs, islands_sampled=50, invented=60)).collect()
    assert len(rows) == len(odd) + 2
    got = [[(x["kind"], x["start"], x["end"]) for x in r["base"]] for r in rows if r["doc_id"] == 20]
    assert got == [[("email", 2, 16), ("ip", 17, 25)]] * 2
    assert all(set(map(tuple, r["base"])) <= set(map(tuple, r["spans"])) for r in rows)
    assert pii.find(docs.where("false"), pii.train([])).count() == 0
