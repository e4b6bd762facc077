"""Joins on time, windows stitched over stretches and captures around peaks, against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gridpulse.operators import temporal, windows

T0 = dt.datetime(2024, 1, 1)


def at(s):
    return None if s is None else T0 + dt.timedelta(seconds=s)


def text(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("block", [10, 100_000])
def test_interval_join(spark, block):
    """Half of all rows stand within one minute of one key: blocks of ten split that bucket."""
    rng = random.Random(2)
    pick = lambda: rng.choice([rng.uniform(0, 30), rng.uniform(-500, 5000)])
    left = [(rng.choice(["a", "a", "b", None]), at(None if i % 40 == 0 else round(pick(), 3)), i) for i in range(250)]
    right = [(rng.choice(["a", "a", "b", "c"]), at(None if i % 50 == 0 else round(pick(), 3)), i) for i in range(250)]
    left += [("a", at(100), 1000), ("a", at(100), 1000)]
    right += [("a", at(95), 2000), ("a", at(103), 2001), ("a", at(94.999), 2002), ("a", at(103.001), 2003)]
    a, b = (spark.createDataFrame(x, "k string, ts timestamp_ntz, id long") for x in (left, right))
    got = temporal.interval_join(a, b, 5, 3, ("k",), block)
    want = [(p[0], p[2], q[2]) for p in left for q in right if p[0] and p[0] == q[0] and p[1] and q[1] and -5 <= (q[1] - p[1]).total_seconds() <= 3]
    assert sorted((r["k"], r["id_a"], r["id_b"]) for r in got.collect()) == sorted(want) and len(want) > 1000
    assert "NestedLoop" not in text(got) and "Cartesian" not in text(got)
    assert temporal.interval_join(a.where("false"), b, 5, 3, ("k",)).count() == 0


def test_cooccurrence(spark):
    rng = random.Random(4)
    rows = [(f"s{rng.randrange(4)}", rng.choice("xyz"), i, at(rng.randrange(400))) for i in range(150)] + [(None, "x", 500, at(1)), ("s1", None, 501, at(1))]
    got = temporal.cooccurrence(spark.createDataFrame(rows, "sig_key string, cid string, event_id long, ts timestamp_ntz"), 10)
    want = {}
    good = [r for r in rows if r[0] and r[1]]
    for a in good:
        for b in good:
            gap = abs((a[3] - b[3]).total_seconds())
            if a[0] != b[0] and (a[1], a[2]) < (b[1], b[2]) and gap <= 10:
                want.setdefault((a[1], b[1]), []).append((gap, a[0], b[0]))
    found = {(r["cid_a"], r["cid_b"]): (r["n_pairs"], r["n_signals"], r["mean_gap_s"], r["least_gap_s"]) for r in got.collect()}
    assert found == {k: (len(v), len({x[1:] for x in v}), pytest.approx(sum(x[0] for x in v) / len(v), abs=1e-4), min(x[0] for x in v)) for k, v in want.items()}


def test_as_of(spark):
    rng = random.Random(7)
    left = [(rng.choice(["a", "b", None]), at(rng.randrange(-50, 900)), i) for i in range(200)] + [("a", None, 999)]
    right = [(rng.choice(["a", "a", "b"]), at(rng.randrange(0, 600)), f"f{i % 17}") for i in range(60)] + [("a", None, "f")]
    a, b = spark.createDataFrame(left, "k string, ts timestamp_ntz, id long"), spark.createDataFrame(right, "k string, ts timestamp_ntz, name string")
    got = {r["id"]: r["found"] and (r["found"]["ts"], r["found"]["name"]) for r in temporal.as_of(a, b, ["k"], 60).collect()}
    want = {i: max(((t, n) for kk, t, n in right if k == kk and k and t and s and dt.timedelta(0) <= s - t < dt.timedelta(seconds=60)), default=None) for k, s, i in left}
    assert got == want and sum(v is not None for v in want.values()) > 50


def test_names_of_captures_and_peaks(spark):
    df = spark.createDataFrame([("/x/2024-03-01_10-30.txt",), ("/x/2024-3-1.txt",), ("/2024-03-01_10-30.txt/other.txt",), ("v_timestamp_2024-03-01_10-30-05.png",), ("/x/2024-13-01_10-30.txt",)], "p string")
    rows = df.select(temporal.named_time("p", temporal.CAPTURE_NAME).alias("c"), temporal.named_time("p", temporal.PEAK_NAME).alias("k")).collect()
    assert [r["c"] for r in rows] == [dt.datetime(2024, 3, 1, 10, 30), None, None, None, None]
    assert [r["k"] for r in rows] == [None, None, None, dt.datetime(2024, 3, 1, 10, 30, 5), None]


def test_only_partitions_near_peaks_are_read(spark, tmp_path):
    """Samples within a second of a peak, also over midnight and only within the capture; other partitions are not opened."""
    rows = []
    for voie in (1, 2):
        for day in range(1, 5):
            for s in (0, 0.5, 1.0, 40_000, 86_399, 86_399.5):
                t = dt.datetime(2024, 1, day) + dt.timedelta(seconds=s)
                rows.append(("boitier_1", voie, t.date(), t, 0, float(day * 100_000 + s)))
    lake = "boitier string, voie int, date date, ts timestamp_ntz, tie int, signal double"
    spark.createDataFrame(rows, lake).write.partitionBy("boitier", "voie", "date").parquet(f"{tmp_path}/lake")
    peaks = [("boitier_1", 1, dt.datetime(2024, 1, 2, 23, 59, 59, 600_000)), ("boitier_1", 1, dt.datetime(2024, 1, 3, 12, 0))]
    captures = [("boitier_1", 1, dt.datetime(2024, 1, 2, 23, 30)), ("boitier_1", 1, dt.datetime(2024, 1, 3, 11, 0))]
    keys = ["boitier", "voie"]
    p, c = (spark.createDataFrame(x, "boitier string, voie int, ts timestamp_ntz") for x in (peaks, captures))
    covered = temporal.covering(p, c, keys)
    assert {r["ts"]: r["start_ts"] for r in covered.collect()} == {peaks[0][2]: captures[0][2], peaks[1][2]: None}
    near = temporal.peak_partitions(covered.where("start_ts is not null"), spark.read.parquet(f"{tmp_path}/lake"))
    plan = text(near)
    assert "PartitionFilters: [" in plan and "2024-01-02" in plan and "2024-01-03" in plan and "2024-01-01" not in plan
    assert {str(r["date"]) for r in near.collect()} == {"2024-01-02", "2024-01-03"} and {r["voie"] for r in near.collect()} == {1}
    got = temporal.around_peaks(covered, near, keys).collect()
    assert [(r["ts"], r["n"], r["signal"], r["offset_s"]) for r in got] == [(peaks[0][2], 2, [286_399.0, 286_399.5], [pytest.approx(-0.6), pytest.approx(-0.1)])]
    assert temporal.peak_partitions(p.where("false"), spark.read.parquet(f"{tmp_path}/lake")).count() == 0


def test_runs_do_not_depend_on_stretches(spark):
    rng = random.Random(9)
    rows, t = [], 0.0
    for i in range(600):
        t += rng.choice([0.0, 0.1, 0.4, 0.5, 0.5, 0.500001, 3.0])
        rows.append(("a" if i % 3 else "b", at(t), i, float(i)))
    df = spark.createDataFrame(rows, "sig_key string, ts timestamp_ntz, tie long, signal double")
    for key in "ab":
        own = [r for r in rows if r[0] == key]
        grp, want = 0, []
        for k, r in enumerate(own):
            grp += k > 0 and (r[1] - own[k - 1][1]).total_seconds() > 0.5
            want.append(grp)
        for stretch in (0.3, 2.0, 1000.0):
            got = windows.gap_runs(df.where(F.col("sig_key") == key), ["sig_key"], 0.5, stretch).orderBy("ts", "tie").collect()
            assert [r["grp"] for r in got] == want
            no = windows.numbered(df.where(F.col("sig_key") == key), ["sig_key"], stretch).orderBy("ts", "tie").collect()
            assert [r["row_no"] for r in no] == list(range(len(own)))


def test_one_signal_is_spread(spark):
    """A signal without a gap: its rows are put in order in many tasks."""
    df = spark.range(200_000).select(F.lit("a").alias("sig_key"), F.timestamp_micros(F.col("id") * 1000).cast("timestamp_ntz").alias("ts"), F.col("id").alias("tie"), F.col("id").cast("double").alias("signal"))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # so few rows would be broadcast
    try:
        runs = windows.gap_runs(df, ["sig_key"], 0.5, 5.0)
        parts = runs.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.max("grp").alias("g")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(parts) == 8 and max(r["n"] for r in parts) < 80_000 and {r["g"] for r in parts} == {0}


def test_windows_by_order_of_dates_or_files(spark):
    rows = [("s", dt.datetime(2024, 1, d) + dt.timedelta(seconds=k), k, float(d)) for d in (1, 2, 3) for k in range(3)]
    df = spark.createDataFrame(rows, "sig_key string, ts timestamp_ntz, tie long, signal double")
    got = windows.gap_windows(df, 2.0, 1, True, ["2024-01-03", "2024-01-01", "2024-01-02"]).orderBy("win_idx").collect()
    assert [r["signal"][0] for r in got] == [3, 1, 2]
    files = df.withColumn("file", F.concat(F.lit("f"), 4 - F.dayofmonth("ts")))
    night = files.union(spark.createDataFrame([("s", dt.datetime(2024, 1, 1, 0, 0, 2, 500_000), 9, 9.0, "f2")], files.schema))
    got = windows.gap_windows(night, 2.0, 1, by="file").orderBy("win_idx").collect()
    assert [(r["signal"][0], r["n"]) for r in got] == [(3, 3), (9, 1), (2, 3), (1, 3)]
