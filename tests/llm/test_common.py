import random

import numpy as np
from pyspark.sql import functions as F

from tallyforge.llm.common import Tables, bitmap_of, components, in_bitmap


def union_find(edges):
    up = {}

    def find(i):
        up.setdefault(i, i)
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for a, b in edges:
        p, q = find(a), find(b)
        up[max(p, q)] = min(p, q)
    return {i: find(i) for i in up}


def test_components(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(100, 180)]
    star = [(500, i) for i in range(501, 620)]
    loose = [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)]
    edges = [*chain, *star, *loose, (-5, 100), (2**62, -(2**62)), (7, 7)]
    rng.shuffle(edges)
    got = components(Tables(spark, "t"), spark.createDataFrame(edges, "a long, b long"))
    want = union_find((a, b) for a, b in edges if a != b)
    assert {r["node"]: r["component"] for r in got.collect()} == want and got.count() == len(want)
    assert components(Tables(spark, "t"), spark.createDataFrame([], "a long, b long")).count() == 0


def test_bitmap(spark):
    ids = np.array([random.Random(2).getrandbits(63) - 2**62 for _ in range(500)], np.int64)
    bitmap = bitmap_of(spark.createDataFrame([(int(i),) for i in ids], "id long"))
    assert in_bitmap(bitmap, ids).all() and in_bitmap(bitmap, np.arange(2000)).mean() < 0.05
    assert not bitmap_of(spark.createDataFrame([], "id long")).any()


def test_tables_keep_and_drop(spark):
    tables = Tables(spark, "t")
    kept = tables.put(spark.range(3).select(F.col("id"), F.lit(None).cast("string").alias("x")), "a")
    assert kept.count() == 3 and tables.put(kept.where("false"), "b").columns == ["id", "x"]
    tables.drop(kept)
    assert tables.put(spark.range(1).toDF("id"), "a").count() == 1
