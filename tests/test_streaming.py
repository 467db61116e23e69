"""The filter as a stream against the batch query: order, lateness, restart."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.operators import kalman
from tallyforge.streaming.filter import stream_filter

from .test_structure import frame, random_bars


def test_state_survives_as_numbers():
    options = kalman.Options("ohlc4", True, True, False)
    whole, parts = kalman.Tracker(options), kalman.Tracker(options)
    for k, r in enumerate(random_bars(4, 60)):
        if k % 7 == 0:
            parts = kalman.Tracker.of(parts.numbers(), options)
        assert whole.step(*r[2:]) == parts.step(*r[2:])


def run(spark, source, out, state, schema):
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source))
    found = stream_filter(stream, "5 hours")
    query = found.writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(state)).trigger(availableNow=True).start()
    query.awaitTermination(240)
    assert query.exception() is None
    return sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])


@pytest.mark.parametrize("options", [kalman.Options()])
def test_stream_equals_batch(spark, tmp_path, options):
    """Bars out of order within the watermark, two series, a stop and a start in between, one bar too late."""
    rng = random.Random(3)
    rows = random_bars(1, 60, "A") + random_bars(2, 45, "B")
    rows = [(*r[:6], None if r[1] == 7 else r[6]) for r in rows]
    rows.sort(key=lambda r: r[1] + rng.uniform(0, 4))
    ends = [("A", 500, 1.0, 1.0, 1.0, 1.0, 1), ("B", 500, 1.0, 1.0, 1.0, 1.0, 1)]
    late = ("A", 2, 9.0, 9.0, 9.0, 9.0, 9)
    parts = [rows[:40], rows[40:70], [*rows[70:], late], ends]
    source, out, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    schema = frame(spark, rows).schema
    dropped = 0
    for k, part in enumerate(parts):
        frame(spark, part).coalesce(1).write.mode("append").parquet(str(source))
        if k != 1:  # the second and third part come while the query is down
            dropped += run(spark, source, out, state, schema)
    want = kalman.imm_kalman(frame(spark, rows), options=options).collect()
    got = spark.read.parquet(str(out)).where("i < 500").collect()
    assert dropped == 1 and len(got) == len(rows)
    by = lambda t: {(r["symbol"], r["i"]): [r[c] for c in kalman.COLUMNS] for r in t}
    want, got = by(want), by(got)
    assert all(np.allclose(got[k], want[k], rtol=1e-12, atol=1e-12) for k in want)


def test_refused(spark):
    df = frame(spark, random_bars(1, 3))
    with pytest.raises(ValueError, match="exist"):
        stream_filter(df.withColumn("Snap", F.lit(1)))
