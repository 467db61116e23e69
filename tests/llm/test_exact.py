import hashlib
import random
import re

import pytest

from tallyforge.llm import exact


def normal(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def brute(rows):
    """Of each row's text: the smallest doc_id (null last), the size of its group."""
    by = {}
    for i, t in rows:
        by.setdefault(normal(t), []).append(i)
    return {t: (min((i for i in ids if i is not None), default=None), len(ids)) for t, ids in by.items()}


def held(rows, got):
    want = brute(rows)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(((r["doc_id"], r["sha"]) for r in got), key=key) == sorted(((i, hashlib.sha256(normal(t).encode()).hexdigest()) for i, t in rows), key=key)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): x for t, x in want.items()}
    stay = {}
    for r in got:
        assert (r["keep_id"], r["group_size"]) == by_sha[r["sha"]]
        if r["kept"]:
            assert r["doc_id"] == r["keep_id"]
            stay[r["sha"]] = stay.get(r["sha"], 0) + 1
    assert stay == dict.fromkeys(by_sha, 1)


def found(docs, **options):
    from pyspark.sql import functions as F

    return exact.groups(docs.withColumn("sha", F.sha2(exact.normalised(F.col("text")), 256)), **options)


@pytest.mark.parametrize("most", [exact.BROADCAST_ROWS, 0])
def test_against_brute_force(spark, documents, odd, most):
    """Copies but for white space, common lengths and prefixes, repeated and null ids; keys sent to all and shuffled."""
    rng = random.Random(13)
    rows = [*odd, *odd[:4]]
    for i in range(600):
        base = "p" * 70 + "".join(rng.choices("ab", k=3)) if i % 2 else "".join(rng.choices("ab \n", k=rng.randint(0, 9)))
        rows.append((rng.randrange(400), base.replace(" ", rng.choice([" ", "\t\r", "\x0b \x0c"]))))
    rows += [(1000 + i, "one group of a third  of all rows") for i in range(300)]
    got = found(documents(rows), most=most)
    assert "text" not in got.columns and {"lang", "source", "n_chars"} <= set(got.columns)
    held(rows, got.collect())


def test_white_space_is_ascii_only(documents):
    rows = [(1, "a b"), (2, "a b"), (3, "a\x1cb"), (4, "a b"), (5, "a\x85b"), (6, " a b"), (7, "a b "), (8, "a\n\nb")]
    got = {r["doc_id"]: r["keep_id"] for r in found(documents(rows)).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, 8: 1}


def test_long_texts_and_empty_table(documents):
    rows = [(1, "x y " * 500_000), (2, "x  y " * 500_000), (3, "x y " * 499_999 + "x z ")]
    held(rows, found(documents(rows)).collect())
    assert found(documents(rows).where("false")).collect() == []


def test_clashing_names(documents):
    from pyspark.sql import functions as F

    with pytest.raises(ValueError, match="keep_id"):
        exact.groups(documents([(1, "a")]).withColumn("Keep_ID", F.lit(1)))


def test_only_survivors_are_hashed(documents):
    """The mark of the second step: the hash of a text that its length or prefix settles is never taken."""
    from tallyforge.llm import common

    since = common.made()
    exact.groups(documents([(1, "alone"), (2, "twin 1"), (3, "twin 1"), (4, "p" * 64 + "x"), (5, "p" * 64 + "y"), (6, "qwertz")])).collect()
    spark = documents([]).sparkSession
    import glob

    marked = glob.glob(common._folders[since].removeprefix("file://") + "/*-marked")
    got = {r["doc_id"]: r["_hash"] is not None for r in spark.read.parquet("file://" + marked[0]).collect()}
    assert got == {1: False, 2: True, 3: True, 4: True, 5: True, 6: False}
