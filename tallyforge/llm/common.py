"""Shared pieces of the training-data operators: shared tables, bitmap prefilter, connected components."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session.

    Only where the session names none and runs on this machine alone (tests, a laptop) a temporary folder is set.
    """
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tallyforge-")
        sc.setCheckpointDir(found)
    return found


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bytes of texts that a Python worker receives at once (or one longer text), and rows.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 10_000


_kept: list = [None, None]


def kept(name: tuple, make: Callable):
    """What a worker process keeps from task to task under this name; it keeps one such thing at most."""
    if _kept[0] != name:
        _kept[:] = [None, None]
        _kept[:] = [name, make()]
    return _kept[1]


def lean(run: Callable, name: tuple | None = None) -> Callable:
    """A batch function over texts that is careful with memory.

    The session's Arrow batches are bounded by BATCH_BYTES from here on; a worker, which outlives its tasks,
    drops at the start what it keeps for others, and gives memory back at the end.
    """
    spark = SparkSession.getActiveSession()
    for key, most in (("maxBytesPerBatch", BATCH_BYTES), ("maxRecordsPerBatch", BATCH_ROWS)):
        key = f"spark.sql.execution.arrow.{key}"
        if spark is not None and not 0 < int(spark.conf.get(key).removesuffix("b")) <= most:
            spark.conf.set(key, most)

    def wrapped(batches):
        if _kept[0] != name:
            _kept[:] = [None, None]
            _give_back()
        try:
            yield from run(batches)
        finally:
            _give_back()

    return wrapped


def _give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # not the GNU C library


#: Folders of intermediate tables that were made since release() ran last.
_folders: list[str] = []


def made() -> int:
    """Number of folders of intermediate tables so far, for release()."""
    return len(_folders)


def release(spark: SparkSession, since: int = 0) -> None:
    """Deletes the intermediate tables made since made() returned ``since``. Results that are still lazy read them: write those first."""
    while len(_folders) > since:
        _delete(spark, _folders.pop())


def _delete(spark: SparkSession, path: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


class Tables:
    """Intermediate tables in the shared folder; they cut lineage and outlive a lost executor.

    drop() deletes one that nothing reads any more, release() those of all operators.
    """

    def __init__(self, spark: SparkSession, name: str, lasting: bool = False):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self.n = 0
        if not lasting:
            _folders.append(self.root)

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.root}/{self.n:03d}-{name}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.tallyforge_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables of put()."""
        for df in tables:
            _delete(self.spark, df.tallyforge_path)


#: Bits of the largest bitmap: 8 MB, which are sent with a task's function.
_MOST_BITS = 1 << 26


def bitmap_of(ids: DataFrame) -> np.ndarray:
    """A one-hash Bloom bitmap of a long column ``id``, of 32 bits a row up to _MOST_BITS.

    It only spares work: what passes it is still joined exactly. Beyond some 10 million rows more and more
    passes, so at worst callers store what they would need of every row.
    """
    bits = 1 << min(_MOST_BITS.bit_length() - 1, max(12, 5 + ids.count().bit_length()))
    at = F.col("id").bitwiseAND(bits - 1)
    words = (
        ids.select(F.shiftright(at, 6).alias("w"), F.expr("shiftleft(1L, cast(id & 63 as int))").alias("v"))
        .groupBy("w").agg(F.bit_or("v").alias("v")).toArrow()
    )
    out = np.zeros(bits >> 6, np.uint64)
    out[words["w"].to_numpy()] = words["v"].to_numpy().view(np.uint64)
    return out


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of df has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def in_bitmap(bitmap: np.ndarray, ids: np.ndarray) -> np.ndarray:
    at = ids.view(np.uint64) & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) > 0


_SPREAD = 0x5DEECE66D


def _joined(rows: DataFrame, mins: DataFrame) -> DataFrame:
    """rows(u, v) with the m of mins(u, m).

    Both sides are keyed anew by an expression of u, so that each has an exchange of its own and
    AQE can split the rows of a hub.
    """
    key = F.col("u").bitwiseXOR(F.lit(_SPREAD))
    return rows.withColumn("k", key).join(mins.select(key.alias("k"), "m"), "k").drop("k")


def components(tables: Tables, edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that edges(a, b) reach, for each node that has an edge.

    Alternating large-star and small-star rounds; each round is a pre-aggregated minimum and a join
    on node ids, and its edges are written to the shared folder, so neither a hub nor a long chain
    meets in one task, and the number of rounds grows with the logarithm of the longest chain.
    """
    e = tables.put(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    for _ in range(rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        mins = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _joined(both, mins).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        mins = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            _joined(large, mins).select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")))).alias("x"))
            .select("x.u", "x.v").where("u <> v").distinct()
        )
        new = tables.put(small, "stars")
        state = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        tables.drop(e)
        e = new
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component")))
