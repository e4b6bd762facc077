"""One signal path from flagged windows to the event profile: peaks, filter, chain, metrics, types."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.functions import signal as S
from gridpulse.operators import events as E
from gridpulse.operators import windows as W
from gridpulse.sources.stage import staged

PEAK_LABEL = "type : pic"


@dataclass(frozen=True)
class Settings:
    """Thresholds of an analysis."""

    gap_s: float = 0.5
    min_len: int = 100
    split_by_date: bool = True
    n_segments: int = 10
    anomaly_threshold: float = 55.0
    peak_threshold: float = 30.0
    search_width: int = 50
    separation: float = 400.0
    energy_size: int = 5
    energy_threshold: float = 10_000.0
    cutoff_hz: float = 1_000.0
    ncc_threshold: float = 0.8
    max_lag: int = 5_000
    type_threshold: float = 0.8


def flagged(samples: DataFrame, s: Settings = Settings(), dates: list[str] | None = None) -> DataFrame:
    """All windows of ``samples`` with ``is_anomaly``, ``peak_count``, ``peak_type``, ``peak_energy``, ``peak_forme``.

    A window is anomalous if its mean range and both its peaks reach their thresholds;
    only anomalous windows are classified by peaks. Padded windows are written once, so that
    no filter on what is told from them makes them again, value by value.
    """
    w = W.centre_pad(W.gap_windows(samples, s.gap_s, s.min_len, s.split_by_date, dates, "file" if "file" in samples.columns else None))
    w = W.energy(W.two_sided(W.segment_range(staged(w), s.n_segments, s.anomaly_threshold), s.peak_threshold), s.energy_size)
    w = w.withColumn("is_anomaly", F.col("is_anomaly") & F.col("has_peak"))
    count = F.when(F.col("is_anomaly"), S.peaks_udf(s.search_width, s.separation)("signal")).otherwise(F.lit(0).cast("long"))
    w = w.withColumn("peak_count", count).withColumnRenamed("energy", "peak_energy")
    w = w.withColumn("peak_type", F.when(F.col("peak_count") > 0, F.concat(F.lit("pic_"), F.col("peak_count").cast("string"))).otherwise(""))
    return w.withColumn("peak_forme", (F.col("peak_type") != "") & (F.col("peak_energy") > s.energy_threshold))


def split(windows: DataFrame) -> DataFrame:
    """``regular``: anomalous windows that are no peaks take part in chaining."""
    return windows.withColumn("regular", F.col("is_anomaly") & (F.col("peak_type") == ""))


def tracked(windows: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Windows of all events: ``event`` (regular events by chaining, each peak window one of its own), ``ref_idx``, ``ncc_vs_ref``, ``dom_freqs4``.

    Similarity is taken on the low-passed windows, references and frequencies on the
    raw ones. Peak windows have neither similarity nor frequency. ``win_idx`` has no holes,
    so only anomalous windows are classified, low-passed and kept.
    """
    # Read for the chain and the peaks; the chain for references and metrics.
    w = staged(split(windows).where("is_anomaly").withColumn("filtered", S.low_pass_udf(s.cutoff_hz)("signal", "seconds")))
    chained = staged(E.chain(w.where("regular"), s.ncc_threshold, s.max_lag, "filtered", dense=True))
    regular = E.metrics(chained, E.references(chained), s.max_lag, "filtered").withColumn("dom_freqs4", S.spectrum_udf(4)("signal", "seconds"))
    kept = ["sig_key", "win_idx", "start_ts", "signal", "filtered", "peak_count", "peak_type", "peak_energy", "peak_forme"]
    regular = regular.select(*kept, F.struct(F.lit(0).alias("peak"), F.col("event_idx").alias("n")).alias("event"), "ref_idx", "ncc_vs_ref", "dom_freqs4")
    peaks = w.where("peak_type <> ''").select(*kept, F.struct(F.lit(1).alias("peak"), F.col("win_idx").alias("n")).alias("event"), F.col("win_idx").alias("ref_idx"), F.lit(None).cast("double").alias("ncc_vs_ref"), F.lit(None).cast("array<double>").alias("dom_freqs4"))
    return regular.union(peaks)


def events(windows: DataFrame) -> DataFrame:
    """One row per event of ``tracked`` windows, numbered by its first time: the fields of a profile without types.

    Metrics that an event lacks have defaults: similarity 1, frequency 0, four zeros.
    ``duration_s`` is from the first to the last start.
    """
    zero4 = F.array(*(F.lit(0.0) for _ in range(4)))
    is_ref = F.col("win_idx") == F.col("ref_idx")  # only its arrays travel
    row = F.struct("win_idx", "start_ts", F.coalesce("ncc_vs_ref", F.lit(1.0)).alias("ncc"), F.coalesce(F.get("dom_freqs4", F.lit(0)), F.lit(0.0)).alias("freq"), F.coalesce("dom_freqs4", zero4).alias("freqs4"), is_ref.alias("is_ref"), F.when(is_ref, F.col("signal")).alias("signal"), F.when(is_ref, F.col("filtered")).alias("filtered"), "peak_count", "peak_type", "peak_energy", "peak_forme")
    e = windows.groupBy("sig_key", "event").agg(F.array_sort(F.collect_list(row)).alias("w"))
    ref = F.get(F.filter("w", lambda x: x["is_ref"]), F.lit(0))
    e = e.withColumn("ref", ref).withColumn("ref_timestamp", F.get("w", F.lit(0))["start_ts"]).withColumn("last", F.element_at("w", -1)["start_ts"])
    e = e.withColumn("event_id", (F.row_number().over(Window.partitionBy("sig_key").orderBy("ref_timestamp", "event")) - 1).cast("int"))
    seconds = (W.micros("last") - W.micros("ref_timestamp")) / 1e6
    field = lambda c: F.transform("w", lambda x: x[c])
    return e.select(
        "sig_key", "event_id", (F.col("event.peak") == 1).alias("is_peak"), F.col("event.n").alias("event_idx"), F.col("ref.win_idx").alias("ref_win_idx"), "ref_timestamp",
        F.col("ref.signal").alias("ref_window"), F.col("ref.filtered").alias("ref_filtered"), F.col("ref.freq").alias("ref_dom_freq"), F.col("ref.freqs4").alias("ref_dom_freqs4"), field("start_ts").alias("window_timestamps"),
        field("ncc").alias("ncc_vs_ref"), field("freq").alias("dom_freqs"), F.size("w").alias("window_count"), F.greatest(seconds, F.lit(0.0)).alias("duration_s"),
        F.col("ref.peak_count").cast("int").alias("peak_count"), F.col("ref.peak_type").alias("peak_type"), F.col("ref.peak_energy").alias("peak_energy"), F.col("ref.peak_forme").alias("peak_forme"),
    )


def typed(found: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Events with ``cluster_id`` and ``type_label``: regular ones by average linkage, all peaks one type after the last regular one."""
    found = staged(found)  # read for the types and the events
    regular = found.where("not is_peak").select("sig_key", "event_idx", F.col("ref_filtered").alias("signal"))
    types = staged(E.cluster_types(regular, s.type_threshold, s.max_lag).select("sig_key", "event_idx", F.lit(False).alias("is_peak"), F.col("type_id").cast("int").alias("type_id")))
    n = types.groupBy("sig_key").agg((F.max("type_id") + 1).alias("n_regular"))
    out = found.join(types, ["sig_key", "event_idx", "is_peak"], "left").join(n, "sig_key", "left")
    out = out.withColumn("cluster_id", F.when(F.col("is_peak"), F.coalesce("n_regular", F.lit(0))).otherwise(F.col("type_id")))
    label = F.when(F.col("is_peak"), F.lit(PEAK_LABEL)).otherwise(F.concat(F.lit("Type "), F.col("cluster_id").cast("string")))
    return out.withColumn("type_label", label).drop("type_id", "n_regular", "event_idx", "ref_filtered")


def profile(found: DataFrame) -> DataFrame:
    """One row per signal: events in order, windows, types and the span; the end is the last start of a window."""
    fields = [c for c in found.columns if c not in ("sig_key", "is_peak")]
    p = found.groupBy(F.col("sig_key").alias("signal_id")).agg(
        F.array_sort(F.collect_list(F.struct("event_id", *(c for c in fields if c != "event_id")))).alias("events"), F.sum("window_count").alias("total_windows"),
        (F.max("cluster_id") + 1).alias("n_clusters"), F.min("ref_timestamp").alias("t_start"), F.max(F.element_at("window_timestamps", -1)).alias("t_end"),
    )
    return p.select("signal_id", "events", "total_windows", "t_start", "t_end", "n_clusters")


def analyse(samples: DataFrame, s: Settings = Settings(), dates: list[str] | None = None) -> DataFrame:
    """Events with types of all signals in ``samples``: ``sig_key, ts, signal, tie``, and ``file`` if windows are cut per file."""
    return typed(events(tracked(flagged(samples, s, dates), s)), s)


def event_table(found: DataFrame) -> DataFrame:
    """The rows of the event table of a report; the reference's own 0 counts in the mean similarity."""
    mean = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x) / F.size(c)
    return found.select("sig_key", "event_id", "type_label", "ref_timestamp", "window_count", F.round("duration_s", 1).alias("duration_s"), F.round(mean("dom_freqs"), 1).alias("mean_freq"), F.round(mean("ncc_vs_ref"), 4).alias("mean_ncc"))


def gallery(found: DataFrame) -> DataFrame:
    """Events of each type in order of ``event_id``, with their place in the type's row of reference windows."""
    order = Window.partitionBy("sig_key", "cluster_id").orderBy("event_id")
    return found.select("sig_key", "cluster_id", (F.row_number().over(order) - 1).cast("int").alias("place"), "event_id", "ref_win_idx", "ref_window")


def type_windows(found: DataFrame) -> DataFrame:
    """``sig_key, cid, window``: the reference of each type's first event, as float32."""
    first = found.groupBy("sig_key", F.col("cluster_id").alias("cid")).agg(F.min_by("ref_window", "event_id").alias("window"))
    return first.withColumn("window", F.col("window").cast("array<float>"))


def arriving_types(found: DataFrame) -> DataFrame:
    """``sig_key, cluster_id, name, window`` of the regular types of all signals, named so that they sort by signal and ascending id, with the raw reference of their earliest event."""
    own = found.where("not is_peak").groupBy("sig_key", "cluster_id").agg(F.min_by("ref_window", F.struct("ref_timestamp", "event_id")).alias("window"))
    return own.withColumn("name", F.concat("sig_key", F.lit("/"), F.lpad(F.col("cluster_id").cast("string"), 9, "0")))
