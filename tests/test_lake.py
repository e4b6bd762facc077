"""Text captures to the lake and on to profiles, through files."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridpulse import cli
from gridpulse.functions import sql
from gridpulse.operators import correlate, profiles, reports
from gridpulse.sources import lake
from gridpulse.sources.registry import Conflict, Registry
from gridpulse.streaming import sessions


def write(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


def test_times_of_all_spellings(spark, tmp_path):
    times = ["2024-03-31 02:30:00", "2024-03-31 02:30:00.5", "2024-03-31T02:30:00.123456", "2024/03/31 02:30:01", "03/31/2024 02:30:02.25", "2024-03-31", "nonsense"]
    write(tmp_path / "in" / "boitier_3" / "2024-03-31_a.txt", [f"{t},{i},{i + 0.5},-{i}" for i, t in enumerate(times)])
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        rows = lake.read_text(spark, f"{tmp_path}/in").where("voie = 1").orderBy("tie").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [r["ts"] for r in rows] == [dt.datetime(2024, 3, 31, 2, 30), dt.datetime(2024, 3, 31, 2, 30, 0, 500000), dt.datetime(2024, 3, 31, 2, 30, 0, 123456), dt.datetime(2024, 3, 31, 2, 30, 1), dt.datetime(2024, 3, 31, 2, 30, 2, 250000), dt.datetime(2024, 3, 31)]
    assert [r["t"] for r in lake.rejected(spark, f"{tmp_path}/in").collect()] == ["nonsense"]
    assert [(r["lines"], r["bad"], r["status"]) for r in lake.file_status(spark, f"{tmp_path}/in").collect()] == [(7, 1, "partial")]


def test_ingest_twice(spark, tmp_path):
    """A first write keeps equal times; later ones keep the lake's rows and the first of new ones."""
    name = "boitier_1/2024-01-02_x.txt"
    write(tmp_path / "a" / name, ["2024-01-02 00:00:00,1,2,3", "2024-01-02 00:00:00,4,5,6", "2024-01-02 00:00:02,7,8,9"])
    write(tmp_path / "b" / name, ["2024-01-02 00:00:01,10,11,12", "2024-01-02 00:00:01,20,21,22", "2024-01-02 00:00:02,30,31,32"])
    write(tmp_path / "b" / "TRMS" / "boitier_1" / "2024-01-02_x.txt", ["2024-01-02 00:00:00," + ",".join(map(str, range(12)))])
    target = f"{tmp_path}/lake"
    assert cli.ingest(spark, f"{tmp_path}/a", target, ("oscillo",)).collect()[0]["status"] == "ok"
    read = lambda: [(r["ts"].second, r["signal"]) for r in lake.scan(spark, f"{target}/oscillo", "boitier_1", 1, ["2024-01-02"]).orderBy("ts", "signal").collect()]
    assert read() == [(0, 1), (0, 4), (2, 7)]
    cli.ingest(spark, f"{tmp_path}/b", target)
    assert read() == [(0, 1), (1, 10), (2, 7)]
    trms = lake.scan(spark, f"{target}/TRMS", "boitier_1", 2, ["2024-01-02"], "TRMS").collect()
    assert [(r["min"], r["max"], r["moy"], r["efficace"]) for r in trms] == [(4, 5, 6, 7)]
    with pytest.raises(FileNotFoundError):
        lake.scan(spark, f"{target}/oscillo", "boitier_1", 1, ["2024-01-02", "2024-01-03"])


def test_first_write_is_decided_per_target(spark, tmp_path):
    """A new date in a lake that exists keeps its equal times, as the first date did."""
    for day in ("2024-01-02", "2024-01-03"):
        write(tmp_path / day / f"boitier_1/{day}_x.txt", [f"{day} 00:00:00,1,2,3", f"{day} 00:00:00,4,5,6"])
        cli.ingest(spark, f"{tmp_path}/{day}", f"{tmp_path}/lake", ("oscillo",))
    count = lambda: {str(r["date"]): r["count"] for r in spark.read.parquet(f"{tmp_path}/lake/oscillo").where("voie = 1").groupBy("date").count().collect()}
    assert count() == {"2024-01-02": 2, "2024-01-03": 2}
    cli.ingest(spark, f"{tmp_path}/2024-01-03", f"{tmp_path}/lake", ("oscillo",))
    assert count() == {"2024-01-02": 2, "2024-01-03": 1}
    cli.ingest(spark, f"{tmp_path}/2024-01-02", f"{tmp_path}/lake2", ("oscillo",), dedup_on_create=True)
    assert spark.read.parquet(f"{tmp_path}/lake2/oscillo").count() == 3


def test_order_of_equal_times_is_kept(spark, tmp_path):
    """Of 500 equal times in several files of a partition, whatever their order, the first written stays when they are merged again."""
    t = dt.datetime(2024, 1, 2)
    kind = "kind string, boitier string, voie int, date date, ts timestamp_ntz, tie long, signal float"
    first = spark.createDataFrame([("oscillo", "boitier_1", 1, t.date(), t, i, float(i)) for i in range(500)], kind)
    rows = lake.merge(first.orderBy(F.desc("tie")), None, lake.PARTS)
    assert {(r["row_no"], r["signal"]) for r in rows.collect()} == {(i + 1, float(i)) for i in range(500)}
    shuffled = rows.drop("tie").repartition(7, F.xxhash64("signal"))
    shuffled.write.partitionBy(*lake.PARTS).parquet(f"{tmp_path}/lake")
    new = spark.createDataFrame([("oscillo", "boitier_1", 1, t.date(), t, 0, -1.0)], kind)
    old = lake.existing(spark, f"{tmp_path}/lake", new.select(*lake.PARTS).distinct())
    assert [r["signal"] for r in lake.merge(new, old, lake.PARTS).collect()] == [0.0]


def test_values_that_are_no_numbers_are_reported(spark, tmp_path):
    write(tmp_path / "in" / "boitier_1" / "2024-01-02_x.txt", ["2024-01-02 00:00:00,1,oops,3", "2024-01-02 00:00:01,1, 2 ,"])
    s = lake.file_status(spark, f"{tmp_path}/in").collect()[0]
    assert (s["lines"], s["bad"], s["bad_values"], s["status"]) == (2, 0, 1, "partial")
    assert sorted((r["voie"], r["signal"]) for r in lake.read_text(spark, f"{tmp_path}/in").where("signal is not null").collect()) == [(1, 1), (1, 1), (2, 2), (3, 3)]


def test_folder_of_files_is_one_signal(spark, tmp_path):
    """Two files, the first over midnight: windows in path order, a file's window not cut at midnight, one chain over both."""
    wave = lambda a, k: a * np.sin(2 * np.pi * 50 * k * 0.001)
    for name, start in (("b.csv", "2024-01-05 10:00:00"), ("a.txt", "2024-01-08 23:59:59.900")):
        begin = dt.datetime.fromisoformat(start)
        write(tmp_path / "folder" / name, [f"{begin + dt.timedelta(milliseconds=k)},{wave(80, k):.6f}" for k in range(200)])
    found = profiles.analyse(lake.read_loose(spark, f"{tmp_path}/folder"), SETTINGS).collect()
    assert [(r["sig_key"], r["window_count"], r["ref_win_idx"]) for r in found] == [("folder", 2, 0)]
    assert found[0]["window_timestamps"] == [dt.datetime(2024, 1, 8, 23, 59, 59, 900_000), dt.datetime(2024, 1, 5, 10)]


def test_two_writers_of_a_registry(spark, tmp_path):
    """Both read version 1; the second finds version 2 taken, decides again and gives no id twice."""
    x = lambda k: [float(v) for v in np.random.default_rng(k).normal(size=32)]
    rows = lambda *ks: spark.createDataFrame([(f"n{k}", x(k)) for k in ks], "name string, window array<double>")
    one, two = Registry(spark, f"{tmp_path}/r"), Registry(spark, f"{tmp_path}/r")
    assert one.assign(rows(1), 0.9) == {"n1": 0}
    commit, raced = two.commit, []

    def late(base, new):
        if not raced:
            raced.append(one.assign(rows(2, 3), 0.9))
        return commit(base, new)

    two.commit = late
    # n3 is new to both; the second run takes the id that the first one gave.
    assert two.assign(rows(1, 3, 4), 0.9) == {"n1": 0, "n3": 2, "n4": 3} and raced == [{"n2": 1, "n3": 2}]
    assert one.ids() == [0, 1, 2, 3] and one.versions() == [1, 2, 3] and one.ids(2) == [0, 1, 2]
    with pytest.raises(Conflict):
        one.commit(1, [(9, x(9))])
    assert one.assign(rows(1, 2, 3, 4), 0.9) == {"n1": 0, "n2": 1, "n3": 2, "n4": 3} and one.versions() == [1, 2, 3]
    assert not [p for p in (tmp_path / "r").iterdir() if p.name.startswith("_draft")]


def test_many_signals_in_one_call(spark, tmp_path):
    for b in (1, 2):
        write(tmp_path / "in" / f"boitier_{b}" / "2024-01-02_x.txt", [f"2024-01-02 00:00:00.{k:03d},{k},{k + 1},{k + 2}" for k in range(3)])
    cli.ingest(spark, f"{tmp_path}/in", f"{tmp_path}/lake", ("oscillo",))
    a = cli.parser().parse_args(["analyse", "--output", "x", "--signal", "boitier_1:1:2024-01-02", "--signal", "boitier_2:3:2024-01-02,2024-01-02", "--no-split-by-date"])
    got = cli.signals(spark, f"{tmp_path}/lake", a.signal).orderBy("sig_key", "ts").collect()
    assert [(r["sig_key"], r["signal"]) for r in got] == [("boitier_1/voie_1", 0), ("boitier_1/voie_1", 1), ("boitier_1/voie_1", 2), ("boitier_2/voie_3", 2), ("boitier_2/voie_3", 3), ("boitier_2/voie_3", 4)] and not a.split_by_date
    with pytest.raises(FileNotFoundError):
        cli.signals(spark, f"{tmp_path}/lake", [("boitier_1", 1, ["2024-01-09"])])


def test_loose_files(spark, tmp_path):
    write(tmp_path / "x" / "a.csv", ["2024-01-01 00:00:00;on;1.5;2", "2024-01-01 00:00:01;off;2.5;3"])
    write(tmp_path / "x" / "b.txt", ["2024-01-01 00:00:00,1", "2024-01-01 00:00:01,2"])
    write(tmp_path / "x" / "c.txt", ["what,1", "2024-01-01 00:00:01,2"])
    got = sorted((r["file"][-5:], r["ts"].second, r["signal"]) for r in lake.read_loose(spark, f"{tmp_path}/x").collect())
    assert {r["sig_key"] for r in lake.read_loose(spark, f"{tmp_path}/x").collect()} == {"x"}
    assert got == [("a.csv", 0, 1.5), ("a.csv", 1, 2.5), ("b.txt", 0, 1), ("b.txt", 1, 2)]
    assert sorted((r["file"][-5:], r["signal"]) for r in lake.read_loose(spark, f"{tmp_path}/x", 1).collect()) == [("a.csv", 2), ("a.csv", 3)]


@pytest.fixture(scope="module")
def samples(spark):
    """Three captures of one wave, a flat one, one with two isolated peaks, in two signals."""
    rng = np.random.default_rng(1)
    t = np.arange(200) * 0.001
    wave = 80 * np.sin(2 * np.pi * 50 * t)
    spikes = np.zeros(200)
    spikes[[40, 140]] = 90
    spikes[[41, 141]] = -70
    spikes += np.tile([31.0, -31.0], 100)
    rows = []
    for key in ("boitier_1/voie_1", "boitier_2/voie_1"):
        for k, x in enumerate([wave, wave * 1.1, np.zeros(200), wave, spikes]):
            x = x + rng.normal(0, 0.1, 200)
            rows += [(key, int((k * 100 + s) * 1e6), i + 1000 * k, float(v)) for i, (s, v) in enumerate(zip(t, x))]
    df = spark.createDataFrame(rows, "sig_key string, us long, tie long, signal double")
    return df.select("sig_key", F.timestamp_micros("us").cast("timestamp_ntz").alias("ts"), "tie", "signal").cache()


SETTINGS = profiles.Settings(split_by_date=False, search_width=1, separation=30.0, anomaly_threshold=50.0)


def test_profile_of_known_captures(spark, samples, tmp_path):
    found = profiles.analyse(samples, SETTINGS).where("sig_key like '%1/voie_1'").orderBy("event_id").collect()
    assert [(r["event_id"], r["is_peak"], r["window_count"], r["ref_win_idx"], r["cluster_id"], r["type_label"]) for r in found] == [(0, False, 2, 1, 0, "Type 0"), (1, False, 1, 3, 0, "Type 0"), (2, True, 1, 4, 1, "type : pic")]
    first, _, peak = found
    one = profiles.analyse(samples, SETTINGS).where("sig_key like '%1/voie_1'")
    assert [(r["type_label"], r["window_count"], r["duration_s"], r["mean_ncc"] > 0.49) for r in profiles.event_table(one).orderBy("event_id").collect()] == [("Type 0", 2, 100.0, True), ("Type 0", 1, 0.0, False), ("type : pic", 1, 0.0, True)]
    assert [(r["cluster_id"], r["place"], r["event_id"]) for r in profiles.gallery(one).orderBy("event_id").collect()] == [(0, 0, 0), (0, 1, 1), (1, 0, 2)]
    assert first["duration_s"] == 100 and first["ncc_vs_ref"][1] == 0 and first["ncc_vs_ref"][0] > 0.99 and {first["ref_dom_freq"], *first["dom_freqs"]} <= {50, 950, 1050, 1950, 2050}  # equal but for rounding at one sample a millisecond
    assert peak["ncc_vs_ref"] == [1.0] and peak["dom_freqs"] == [0.0] and peak["ref_dom_freqs4"] == [0.0] * 4 and (peak["peak_type"], peak["peak_count"]) == ("pic_2", 2)


def test_from_files_to_shared_types(spark, samples, tmp_path):
    out = [f"{tmp_path}/one", f"{tmp_path}/two"]
    for key, path in zip(("boitier_1", "boitier_2"), out):
        cli.analyse(spark, samples.where(F.col("sig_key").startswith(key)), path, SETTINGS, f"{tmp_path}/registry")
    p = lake.read_profile(spark, f"{out[0]}/profile").collect()[0]
    assert (p["signal_id"], p["total_windows"], p["n_clusters"], len(p["events"])) == ("boitier_1/voie_1", 4, 2, 3) and p["t_start"] == dt.datetime(1970, 1, 1) and p["t_end"] == dt.datetime(1970, 1, 1, 0, 6, 40)
    text = next((tmp_path / "one" / "profile").glob("*.json")).read_text()
    slim = json.loads(text)
    del slim["t_start"], slim["t_end"]
    (tmp_path / "slim.json").write_text(json.dumps(slim))
    again = lake.read_profile(spark, f"{tmp_path}/slim.json").collect()[0]
    assert (again["t_start"], again["t_end"]) == (p["t_start"], p["t_end"])
    # The second signal's wave is the first one's type in the registry.
    ids = [[(r["cluster_id"], r["type_id"]) for r in spark.read.parquet(f"{x}/registry_ids").collect()] for x in out]
    assert ids == [[(0, 0)], [(0, 0)]] and Registry(spark, f"{tmp_path}/registry").ids() == [0]
    pairs = cli.correlate(spark, [*out, f"{tmp_path}/none"], f"{tmp_path}/pairs", 0.9).orderBy("pair_idx").collect()
    assert {(r["cid_a"], r["cid_b"]) for r in pairs} == {(0, 0), (1, 1)} and all(r["count_a"] == (2 if r["cid_a"] == 0 else 1) for r in pairs) and [r["ncc"] for r in pairs] == sorted((r["ncc"] for r in pairs), reverse=True)
    # Both signals' events of one type start together.
    together = {(r["cid_a"], r["cid_b"]): (r["n_pairs"], r["least_gap_s"]) for r in spark.read.parquet(f"{tmp_path}/pairs-cooccurrence").collect()}
    assert together == {("boitier_1/voie_1/0", "boitier_2/voie_1/0"): (2, 0.0), ("boitier_1/voie_1/1", "boitier_2/voie_1/1"): (1, 0.0)}
    assert cli.correlate(spark, out[:1], f"{tmp_path}/pairs1") is None
    sql.register(spark)
    names = sql.views(spark, out[0], "one_")
    assert names == ["one_events", "one_event_table", "one_type_windows"]
    assert spark.sql("select max(ncc_full(ref_window, ref_window)) x from one_events").first()["x"] == pytest.approx(1)


def test_parser_has_every_setting():
    a = cli.parser().parse_args(["analyse", "--output", "x", "--ncc-threshold", "0.5", "--search-width", "7"])
    assert (a.ncc_threshold, a.search_width, a.cutoff_hz) == (0.5, 7, 1000.0)


def test_dates(spark):
    assert [str(r["date"]) for r in correlate.date_range(spark, "2024-02-28", "2024-03-01").collect()] == ["2024-02-28", "2024-02-29", "2024-03-01"]
    with pytest.raises(ValueError):
        correlate.date_range(spark, "2024-02-02", "2024-02-01")


def test_few_colours(spark):
    pairs = spark.createDataFrame([(f"s{i}", 0) for i in range(8)], "a string, b int")
    assert [r["color"] for r in reports.color_map(pairs).orderBy("a").collect()] == reports.COLOURS
    more = reports.color_map(pairs.union(spark.createDataFrame([("t", k) for k in range(21)], "a string, b int"))).orderBy("a", "b").collect()
    assert [r["color"] for r in more] == reports.COLOURS + reports.MORE_COLOURS + reports.COLOURS[:1]


def test_stream_ingest(spark, tmp_path):
    kind = "kind string, boitier string, voie int, date date, ts timestamp_ntz, tie long, signal float"
    day = dt.date(2024, 1, 2)
    at = lambda s: dt.datetime(2024, 1, 2, 0, 0, s)
    for k, batch in enumerate(([("oscillo", "boitier_1", 1, day, at(0), 1, 1.0), ("oscillo", "boitier_1", 1, day, at(0), 2, 2.0)], [("oscillo", "boitier_1", 1, day, at(0), 3, 9.0), ("oscillo", "boitier_1", 1, day, at(1), 4, 4.0)])):
        spark.createDataFrame(batch, kind).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        query = sessions.ingest(spark.readStream.schema(kind).parquet(f"{tmp_path}/in"), f"{tmp_path}/lake", f"{tmp_path}/check").trigger(availableNow=True).start()
        query.awaitTermination()
    rows = spark.read.parquet(f"{tmp_path}/lake").orderBy("ts").collect()
    assert [(r["ts"].second, r["signal"]) for r in rows] == [(0, 1.0), (1, 4.0)]
