"""Intermediate tables in the folder that all executors share: they cut lineage and outlive a lost executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Tables that stored() wrote and release() hasn't deleted.
_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; only on one machine alone, where none is set, a temporary folder."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if sc.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tallyforge-")
        sc.setCheckpointDir(found)
    return found


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written once and read from there. Spark knows its size, so it is sent to all executors only if it is small."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drained(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """All that a streaming table has to give now, as a table in the shared folder; its query ends, with its checkpoint beside it."""
    spark = stream.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _written.append(path)
    how = "overwrite" if mode == "complete" else "append"
    query = (
        stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/state").trigger(availableNow=True)
        .foreachBatch(lambda batch, _: batch.write.mode(how).parquet(f"{path}/rows")).start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


def release(spark: SparkSession) -> None:
    """Deletes the tables of stored(). Results that are still lazy read them: write those first."""
    while _written:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
