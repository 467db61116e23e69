import random
import re

import pytest

from tallyforge.llm import lines

INK = re.compile(r"[^\x20\x09-\x0D]")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(rng, s, n, letters):
    s = list(s)
    for _ in range(n):
        at = rng.randrange(len(s) + 1)
        rng.choice([lambda: s.insert(at, rng.choice(letters)), lambda: s.__delitem__(slice(at, at + 1)), lambda: s.__setitem__(slice(at, at + 1), [rng.choice(letters)])])()
    return "".join(s)


@pytest.mark.parametrize("tau", [0, 1, 2, 3])
def test_banded_distance(tau):
    rng = random.Random(tau)
    a = ["".join(rng.choices("abç日", k=rng.randint(0, 30))) for _ in range(2000)]
    b = [edited(rng, s, rng.randint(0, tau + 2), "abç日") for s in a]
    assert lines.edit_within(a, b, tau).tolist() == [distance(x, y) <= tau for x, y in zip(a, b)]


def test_long_lines_are_trimmed():
    rng = random.Random(9)
    a = ["".join(rng.choices("ab", k=700)) for _ in range(60)]
    b = [edited(rng, s, rng.randint(0, 4), "ab") for s in a]
    assert lines.edit_within(a, b, 2).tolist() == [distance(x, y) <= 2 for x, y in zip(a, b)]


@pytest.mark.parametrize("tau", [1, 2, 3])
def test_segments_are_found(tau):
    """Lines within tau edits share a key of which one is an index key."""
    import pyarrow as pa

    from tallyforge.llm.text import flat

    rng = random.Random(tau)
    for _ in range(150):
        a = "".join(rng.choices("abcdefgh", k=rng.randint(tau + 4, 60)))
        b = edited(rng, a, rng.randint(1, tau), "abcdefgh")
        if a == b or min(len(a), len(b)) <= tau:
            continue
        sent = []
        for s in (a, b):
            own = lines.Lines(*flat(pa.array([s])))
            keys, ids = lines.segment_keys(own, own.worded.nonzero()[0], tau)
            sent.append({(int(k), int(i) & 1) for k, i in zip(keys, ids)})
            sketch = ids[:1]
            sent.append(sketch)
        index = lambda x: {k for k, p in x if not p}
        every = lambda x: {k for k, _ in x}
        assert index(sent[0]) & every(sent[2]) or index(sent[2]) & every(sent[0])
        assert lines.sketch_distance(sent[1], sent[3])[0] <= 2 * tau


def brute(rows, tau, per_edit):
    def near(x, y):
        t = min(tau, min(len(x), len(y)) // per_edit)
        return t > 0 and abs(len(x) - len(y)) <= t and distance(x, y) <= t

    rows = sorted(rows)
    first = {}
    for i, text in rows:
        for n, x in enumerate(text.split("\n")):
            if INK.search(x):
                first.setdefault(x, (i, n))
    order = sorted(first.items(), key=lambda x: x[1])
    late = {x for k, (x, _) in enumerate(order) if any(near(x, y) for y, _ in order[:k])}
    return {i: "\n".join(x for n, x in enumerate(text.split("\n")) if not INK.search(x) or first[x] == (i, n) and x not in late) for i, text in rows}


@pytest.mark.parametrize("block", [1024, 3])
def test_whole_tables(spark, documents, block):
    rng = random.Random(7)
    stock = ["".join(rng.choices("abcdef é", k=rng.randint(8, 40))).strip() or "x" for _ in range(40)]
    rows = [(i, "\n".join(rng.choice([lambda: edited(rng, rng.choice(stock), rng.choice([0, 0, 1, 2, 3]), "xyz"), lambda: rng.choice(["", " ", "q"])])() for _ in range(rng.randint(0, 5)))) for i in range(120)]
    got = {r["doc_id"]: r for r in lines.dedup(documents(rows, 5), tau=2, per_edit=8, block=block).collect()}
    want = brute(rows, 2, 8)
    assert {i: r["text"] for i, r in got.items()} == want
    for i, text in rows:
        assert got[i]["n_lines"] - got[i]["n_exact"] - got[i]["n_near"] == (len(want[i].split("\n")) if got[i]["n_exact"] + got[i]["n_near"] < got[i]["n_lines"] else 0)
        assert got[i]["emptied"] == (bool(INK.search(text)) and not INK.search(want[i]))


def test_odd_rows(spark, documents, odd):
    got = lines.dedup(documents(odd))
    rows = got.collect()
    assert len(rows) == len(odd) and got.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    texts = {(r["doc_id"], r["text"]) for r in rows}
    assert (1, None) in texts and (2, "") in texts and (4, "one") in texts and (8, "a\n\nb\r\nc") in texts
    assert lines.dedup(documents(odd).where("false")).count() == 0


def thue_morse(n, a, b):
    return "".join(b if i.bit_count() & 1 else a for i in range(n))


def test_lines_that_collide_modulo_powers_of_two(spark, documents):
    for n in (1024, 2048):
        rows = [(1, thue_morse(n, "a", "b")), (2, thue_morse(n, "b", "a"))]
        got = lines.dedup(documents(rows)).collect()
        assert sorted((r["doc_id"], r["text"], r["n_exact"], r["n_near"]) for r in got) == [(i, t, 0, 0) for i, t in rows]


def test_clashing_names(spark, documents):
    docs = documents([(1, "the same line"), (2, "the same line")]).selectExpr("*", "'x' row", "'y' gone", "'z' row_hash", "'u' gone_lines", "7 line")
    got = {r["doc_id"]: r for r in lines.dedup(docs).collect()}
    assert got[1]["text"] == "the same line" and got[2]["emptied"] and (got[2]["row"], got[2]["gone"], got[2]["row_hash"], got[2]["gone_lines"], got[2]["line"]) == ("x", "y", "z", "u", 7)
    with pytest.raises(ValueError, match="n_lines"):
        lines.dedup(docs.withColumn("N_LINES", docs["line"]))


def test_long_texts(spark, documents):
    """A text of a million characters in one line, and one of many lines."""
    rng = random.Random(3)
    big, many = "long line " * 120_000, "\n".join("".join(rng.choices("abcdefghij ", k=60)) for _ in range(12_000))
    got = {r["doc_id"]: r for r in lines.dedup(documents([(1, big), (2, big), (3, many), (4, big[:-1] + "!")])).collect()}
    assert got[1]["text"] == big and got[2]["n_exact"] == 1 and got[4]["n_near"] == 1
    assert (got[3]["text"], got[3]["n_lines"]) == (many, 12_000)


def numbered(order):
    """Lines that differ in a number of three digits and a letter only."""
    return [f"the same words in each of these lines, but {i:03d} {chr(97 + i % 7)} is the number of this one" for i in order]


@pytest.mark.parametrize("block", [1024, 16])
def test_families_of_near_lines(spark, documents, block):
    """Lines of which some are near to no earlier one, some only to a late one, over one block and over several."""
    rng = random.Random(4)
    order = list(range(0, 1000, 11))
    rng.shuffle(order)
    base = "".join(rng.choices("abcdef ghijk", k=64))
    star = [edited(rng, base, rng.randint(1, 2), "xyz") for _ in range(40)]
    rows = list(enumerate([*numbered(order), *star, base, *(edited(rng, base, 2, "uvw") for _ in range(20))]))
    rng.shuffle(rows)
    got = {r["doc_id"]: r["text"] for r in lines.dedup(documents(rows), tau=2, per_edit=20, block=block).collect()}
    assert got == brute(rows, 2, 20)


def test_rows_of_a_family_of_near_lines(spark, documents, monkeypatch):
    """Intermediate tables grow with the lines, not with the pairs of lines that are near."""
    made, put = [], lines.Tables.put

    def counted(self, df, name):
        out = put(self, df, name)
        made.append((out.count(), name))
        return out

    monkeypatch.setattr(lines.Tables, "put", counted)
    order = list(range(500))
    random.Random(5).shuffle(order)
    got = lines.dedup(documents(list(enumerate(numbered(order))))).select("n_near").collect()
    assert sum(r["n_near"] for r in got) > 490
    assert max(made)[0] < 20 * len(order), made
