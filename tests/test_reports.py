"""Ruptures, shapes, severity, table functions and shared types against planted cases and brute force."""

import datetime as dt

import numpy as np
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from gridpulse import catalog
from gridpulse.functions import signal as S
from gridpulse.functions import tables
from gridpulse.operators import reports, ruptures

DATA = "/root/testdata/sf0.001"


def series(spark, rows):
    df = spark.createDataFrame(rows, "sig_key string, i long, value double")
    return df.select("sig_key", F.timestamp_seconds("i").cast("timestamp_ntz").alias("ts"), F.col("i").alias("tie"), "value")


def test_ruptures_do_not_depend_on_blocks(spark):
    """Planted steps on and beside block edges are found to the row at two block sizes; noise alone has none."""
    rng = np.random.default_rng(3)
    planted = [399, 800, 1201, 2000]
    x = rng.normal(0, 1, 2400)
    for k, p in enumerate(planted):
        x[p:] += 15 if k % 2 else -15
    rows = [("a", i, float(v)) for i, v in enumerate(x)] + [("b", i, float(v)) for i, v in enumerate(rng.normal(0, 1, 900))] + [("c", 1, 2.0), ("d", 1, None)]
    df = series(spark, rows)
    got = [sorted((r["sig_key"], r["row_no"], round(r["jump"], 6)) for r in ruptures.ruptures(df, block=b).collect()) for b in (200, 250_000)]
    assert got[0] == got[1] and [(k, i) for k, i, _ in got[0]] == [("a", p) for p in planted]
    assert [round(j) for *_, j in got[0]] == pytest.approx([-15, 15, -15, 15], abs=1)
    with pytest.raises(ValueError):
        ruptures.candidates(df, block=10)
    assert ruptures.ruptures(df.where("false")).count() == 0


def test_rupture_kernels():
    rng = np.random.default_rng(5)
    x = rng.normal(size=60)
    d = ruptures.derivative(x, 4)
    assert all((np.isnan(d[i]) and not 4 <= i <= 56) or d[i] == np.median(x[i : i + 4]) - np.median(x[i - 4 : i]) for i in range(60))
    a = np.nan_to_num(np.abs(d))
    assert ruptures.extremes(d, 4).tolist() == [i for i in range(60) if a[i] > 0 and a[i] > a[max(0, i - 4) : i].max(initial=0) and a[i] >= a[i : i + 5].max()]
    cost = lambda k: ((x[:k] - x[:k].mean()) ** 2).sum() + ((x[k:] - x[k:].mean()) ** 2).sum()
    best = min(range(5, 56), key=cost)
    k, jump, gain = ruptures.split(x, 5)
    assert k == best and jump == pytest.approx(x[k:].mean() - x[:k].mean()) and gain == pytest.approx(((x - x.mean()) ** 2).sum() - cost(k))


def test_shapes_of_noise_and_sine(spark):
    rng = np.random.default_rng(1)
    t = np.arange(2000) * 0.0002
    noise, sine = rng.normal(size=2000), 3 + np.sin(2 * np.pi * 50 * t)
    rows = [(0, noise.tolist(), t.tolist()), (1, sine.tolist(), t.tolist()), (2, [4.0] * 2000, t.tolist()), (3, [], []), (4, [1.0, 2.0], [0.0, 1.0]), (5, sine.tolist(), [0.0] * 2000)]
    df = spark.createDataFrame(rows, "i int, x array<double>, t array<double>").select("i", S.shape_udf()("x", "t").alias("s")).orderBy("i")
    n, s, flat, none, two, still = (r["s"] for r in df.collect())
    assert n["entropy"] > 0.9 and n["dominant"] < 0.01 and n["autocorrelation"] < 0.15 and not n["is_sine"]
    assert s["entropy"] < 0.01 and s["dominant"] > 0.99 and s["autocorrelation"] > 0.9 and s["is_sine"]
    assert all((x["entropy"], x["dominant"], x["autocorrelation"]) == (0, 0, 0) for x in (flat, none, two)) and still["autocorrelation"] == 0 < still["dominant"]


def test_severity_by_axes(spark):
    rows = [(f"s{i % 3}", i, i % 5, float(i), float(i * 7 % 100), 1.0) for i in range(100)]
    events = spark.createDataFrame(rows, "sig_key string, event_id long, cid int, intensity double, persistence double, frequency double")
    normal = spark.createDataFrame([("s0", 1.0), ("s0", 3.0), ("s1", 2.0)], "sig_key string, intensity double")
    got = {r["event_id"]: r for r in reports.severity_axes(events, normal).collect()}
    assert [sum(r["level"] == x for r in got.values()) for x in ("severe", "moderate", "minor")] == pytest.approx([10, 30, 60], abs=2)
    assert got[3]["z"] == pytest.approx((3 - 2) / 2**0.5) and got[1]["z"] is None and got[2]["z"] is None
    assert got[99]["score"] > got[0]["score"] and {r["recurrence"] for r in got.values()} <= {6.0, 7.0}
    text = reports.severity_axes(events, normal)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "Window" not in text.replace("WindowsSubstitution", "")


def test_table_functions_check_their_arguments(spark):
    tables.register(spark)
    spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 0, 0, k), float(k)) for k in (0, 1, 5)] + [("a", None, 1.0)], "sig_key string, ts timestamp_ntz, signal double").createOrReplaceTempView("few")
    got = spark.sql("SELECT win_idx, n, signal FROM gap_windows(TABLE(few) PARTITION BY sig_key ORDER BY ts, gap_s => 1, min_len => 1)").orderBy("win_idx").collect()
    assert [(r["win_idx"], r["n"], r["signal"]) for r in got] == [(0, 2, [0.0, 1.0]), (1, 1, [5.0])]
    for sql in ("gap_windows(TABLE(SELECT 1 AS x) PARTITION BY x)", "event_chain(TABLE(few) PARTITION BY sig_key)", "gap_windows(1)"):
        with pytest.raises(AnalysisException):
            spark.sql(f"SELECT * FROM {sql}").collect()


def test_shared_types_bars_and_linkage(spark):
    """On whole tables: clusters by plain average linkage, shared pairs one by one, the bars that take part."""
    e = catalog.typed_events(spark, DATA).select("sig_key", "event_id", "is_peak", "cluster_id", "ref_window", "ref_timestamp", "duration_s", "ref_dom_freq").collect()
    first = {}
    for r in sorted(e, key=lambda r: (r["sig_key"], r["cluster_id"], r["event_id"])):
        first.setdefault((r["sig_key"], r["cluster_id"]), np.asarray(r["ref_window"], "float32").astype(float))
    count = {k: sum((r["sig_key"], r["cluster_id"]) == k for r in e) for k in first}
    want = {}
    for a, x in first.items():
        for b, y in first.items():
            if a[0] < b[0]:
                n = min(len(x), len(y))
                c = S.ncc_full(x[None, :n], y[None, :n])[0]
                if c >= 0.8:
                    want[(*a, *b)] = (count[a], count[b], c)
    pairs = catalog.shared_pairs(spark, DATA).collect()
    assert {(r["sig_key_a"], r["cid_a"], r["sig_key_b"], r["cid_b"]): (r["count_a"], r["count_b"], r["ncc"]) for r in pairs} == {k: (a, b, pytest.approx(c, abs=2e-5)) for k, (a, b, c) in want.items()} and want
    shared = {k[:2] for k in want} | {k[2:] for k in want}
    bars = catalog.shared_bars(spark, DATA).collect()
    assert sorted((r["sig_key"], r["event_id"], r["cid"], r["duration_s"]) for r in bars) == sorted((r["sig_key"], r["event_id"], r["cluster_id"], r["duration_s"]) for r in e if (r["sig_key"], r["cluster_id"]) in shared)

    refs = catalog.E.references(catalog.chained(spark, DATA)).select("sig_key", "event_idx", "signal").collect()
    by = {}
    for r in refs:
        by.setdefault(r["sig_key"], {})[r["event_idx"]] = np.asarray(r["signal"], float)
    got = {(r["sig_key"], r["event_idx"]): r["type_id"] for r in catalog.type_linkage(spark, DATA).collect()}
    for key, own in by.items():
        ids = sorted(own)
        d = np.array([[0 if i == j else np.clip(1 - S.ncc_bounded(own[min(i, j)][None], own[max(i, j)][None])[0], 0, 1) for j in ids] for i in ids])
        clusters = [[i] for i in range(len(ids))]
        while len(clusters) > 1:
            far, a, b = min((np.mean([d[p, q] for p in x for q in y]), i, j) for i, x in enumerate(clusters) for j, y in enumerate(clusters) if i < j)
            if far > 1 - catalog.SIMILAR:
                break
            clusters[a] += clusters.pop(b)
        label = {i: k for k, c in enumerate(sorted(clusters, key=min)) for i in c}
        assert [got[key, i] for i in ids] == [label[k] for k in range(len(ids))]


def test_pages(spark, tmp_path):
    """A page a signal with its types and events, names escaped; a page of pairs with the link that bars carry."""
    from gridpulse.sources import pages

    at = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    kind = "sig_key string, event_id int, cluster_id int, type_label string, ref_timestamp timestamp_ntz, window_timestamps array<timestamp_ntz>, window_count int, duration_s double, dom_freqs array<double>, ncc_vs_ref array<double>, ref_window array<double>"
    rows = [
        ("a<b", 0, 0, "Type 0", at(3), [at(3), at(11)], 2, 480.0, [50.0, 60.0], [0.0, 0.9], [float(v) for v in range(1000)]),
        ("a<b", 1, 1, "type : pic", at(25), [at(25)], 1, 0.0, [0.0], [1.0], [1.0, 1.0]),
        ("c", 0, 0, "Type 0", at(10), [at(10)], 1, 0.0, [10.0], [0.0], [1.0, -1.0, 2.0]),
    ]
    found = spark.createDataFrame(rows, kind)
    bins = {(r["sig_key"], r["cluster_id"], r["bin"]): r["n"] for r in reports.occurrence(found, 10).collect()}
    # The only window of the second signal lies on an edge: its grid is empty.
    assert bins == {("a<b", 0, at(0)): 1, ("a<b", 0, at(10)): 1, ("a<b", 0, at(20)): 0, ("a<b", 1, at(0)): 0, ("a<b", 1, at(10)): 0, ("a<b", 1, at(20)): 1}
    types = {(r["sig_key"], r["cluster_id"]): (r["n_events"], r["n_windows"], r["first_ts"], r["first_event"]) for r in reports.type_report(found).collect()}
    assert types == {("a<b", 0): (1, 2, at(3), 0), ("a<b", 1): (1, 1, at(25), 1), ("c", 0): (1, 1, at(10), 0)}
    pages.write(pages.signal_pages(found), f"{tmp_path}/report")
    folders = sorted(p for p in (tmp_path / "report").iterdir() if p.is_dir())
    assert len(folders) == 2
    files = list(folders[0].glob("*.txt"))
    text = files[0].read_text()
    assert len(files) == 1 and text.startswith("<!doctype html>") and "<h1>a&lt;b</h1>" in text and text.count("<tr>") == 4 and text.count("<polyline") == 2 and text.count("<rect") == 3
    assert text.index("Type 0") < text.index("type : pic") < text.index("0.45") and all(0 <= float(y) <= pages.HEIGHT for x in text.split('points="')[1:] for y in (q.split(",")[1] for q in x.split('"')[0].split()))
    pairs = spark.createDataFrame([("a<b", 0, 1, "c", 0, 1, 0.9, 0)], "sig_key_a string, cid_a int, count_a long, sig_key_b string, cid_b int, count_b long, ncc double, pair_idx int")
    bars = found.select("sig_key", F.col("cluster_id").alias("cid"), "event_id")
    assert {(r["sig_key"], r["cid"]): r["pair_idx"] for r in reports.linked(bars, pairs).collect()} == {("a<b", 0): 0, ("a<b", 1): None, ("c", 0): 0}
    windows = found.select("sig_key", F.col("cluster_id").alias("cid"), F.col("ref_window").alias("window"))
    lines = [r["value"] for r in pages.correlation_page(pairs, windows).collect()]
    assert lines[1].count("<polyline") == 2 and "0.9000" in lines[1]
