"""Event chains over a stream against the batch operators, however the rows are split and ordered."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridpulse.operators import events
from gridpulse.streaming import chains, sessions

T0 = dt.datetime(2024, 1, 1)
KIND = "sig_key string, win_idx long, start_ts timestamp_ntz, regular boolean, signal array<double>"


def windows():
    rng = np.random.default_rng(12)
    shapes = [rng.normal(size=24) for _ in range(3)]
    rows = []
    for key in ("a", "b"):
        t = 0
        for i in range(40):
            t += int(rng.integers(1, 50))
            x = shapes[int(rng.integers(0, 2)) if i % 3 else 2] + rng.normal(0, 0.2, 24)
            rows.append((key, i, T0 + dt.timedelta(seconds=t), bool(rng.random() < 0.8), [float(v) for v in x]))
    return rows


@pytest.mark.parametrize("seed,batches", [(1, 1), (2, 4), (3, 9)])
def test_chains_equal_the_batch(spark, tmp_path, seed, batches):
    rows = windows()
    df = spark.createDataFrame(rows, KIND)
    chained = events.chain(df, 0.6)
    best = events.references(chained).select("sig_key", "event_idx", F.col("start_ts").alias("ref_ts"))
    want = chained.groupBy("sig_key", "event_idx").agg(F.min("start_ts").alias("first_ts"), F.max("start_ts").alias("last_ts"), F.count("*").alias("n")).join(best, ["sig_key", "event_idx"])
    # Rows within the watermark's reach of each other may come in any order.
    order = sorted(rows, key=lambda r: r[2] + dt.timedelta(seconds=random.Random(f"{seed}{r[0]}{r[1]}").uniform(0, 300)))
    order += [("z", 0, T0 + dt.timedelta(days=30), False, [0.0])]
    for k in range(batches + 2):
        part = order[k * len(order) // batches : (k + 1) * len(order) // batches] if k < batches else [("z", k, T0 + dt.timedelta(days=31 + k), False, [0.0])]
        spark.createDataFrame(part, KIND).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    chains.use_state(spark)
    try:
        stream = spark.readStream.schema(KIND).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        out = chains.chain_events(stream, 0.6, late="10 minutes")
        query = out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/check").outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    got = spark.read.parquet(f"{tmp_path}/out").where("sig_key <> 'z'").collect()
    key = lambda r: (r[0], r[1])
    assert sorted((tuple(r) for r in got), key=key) == sorted(((r["sig_key"], r["event_idx"], r["first_ts"], r["last_ts"], r["n"], r["ref_ts"]) for r in want.collect()), key=key)
    assert len(got) > 20


def test_session_windows(spark, tmp_path):
    """A gap of exactly the limit does not part a session; short ones and the open one do not come out."""
    seconds = [0, 0.5, 1.0, 1.6, 1.7, 9, 10_000]
    kind = "sig_key string, ts timestamp_ntz, signal double"
    for k, s in enumerate(seconds):
        spark.createDataFrame([("a", T0 + dt.timedelta(seconds=s), float(k))], kind).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 3).parquet(f"{tmp_path}/in")
    query = sessions.session_windows(stream, 0.5, 2, "1 minute").writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    query.awaitTermination()
    got = sorted((r["start_ts"], r["end_ts"], r["n"], r["mean"], r["low"], r["high"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    at = lambda s: T0 + dt.timedelta(seconds=s)
    assert got == [(at(0), at(1), 3, 1.0, 0.0, 2.0), (at(1.6), at(1.7), 2, 3.5, 3.0, 4.0)]
