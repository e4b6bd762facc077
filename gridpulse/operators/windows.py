"""From samples to flagged windows. Samples have ``sig_key, ts, signal`` and ``tie``, which orders equal times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.sources.stage import staged


def micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


#: A signal's rows are put in order per stretch of time, this many gaps long, and the stretches are joined by their ends.
STRETCH = 120


def in_stretches(rows: DataFrame, keys: list[str], stretch_s: float) -> tuple[DataFrame, list[str]]:
    """``rows`` with keys and a time, with their ``__part``, and the columns that name a stretch."""
    part = F.floor(micros("ts") / F.lit(max(round(stretch_s * 1e6), 1))).cast("long")
    return rows.where(" and ".join(f"{c} is not null" for c in [*keys, "ts"])).withColumn("__part", part), [*keys, "__part"]


def pieces_of_runs(rows: DataFrame, keys: list[str], gap_s: float, stretch_s: float | None = None) -> tuple[DataFrame, DataFrame, list[str]]:
    """``rows`` with ``__run``, the run within their stretch; one row for each such piece with its ``grp``; the columns of a stretch.

    Rows are compared within stretches of time. A piece goes on with the run of the one
    before it unless more than ``gap_s`` lies between, which is told from one row a piece. So
    a signal is spread over its stretches and only their ends meet. Rows without a key or a time are left out.
    """
    cell = [*keys, "__part"]
    pieces = in_runs(rows.select(*keys, "ts", "tie"), keys, gap_s, stretch_s).groupBy(*cell, "__run").agg(F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"), F.count("*").alias("n"))
    return in_runs(rows, keys, gap_s, stretch_s), with_groups(pieces, keys, gap_s), cell


def in_runs(rows: DataFrame, keys: list[str], gap_s: float, stretch_s: float | None = None) -> DataFrame:
    """``rows`` with ``__part`` and ``__run``, the run within their stretch."""
    s, cell = in_stretches(rows, keys, stretch_s or gap_s * STRETCH)
    order = Window.partitionBy(*cell).orderBy("ts", "tie")
    s = s.withColumn("__run", F.coalesce((micros("ts") - F.lag(micros("ts")).over(order) > int(gap_s * 1e6)).cast("long"), F.lit(0)))
    return s.withColumn("__run", F.sum("__run").over(order.rowsBetween(Window.unboundedPreceding, 0)))


def with_groups(pieces: DataFrame, keys: list[str], gap_s: float) -> DataFrame:
    """One row a piece with ``grp``, which grows by one where more than ``gap_s`` has passed since the piece before."""
    before = Window.partitionBy(*keys).orderBy("__part", "__run")
    starts = F.coalesce((micros("start_ts") - F.lag(micros("end_ts")).over(before) > int(gap_s * 1e6)).cast("long"), F.lit(0))
    return pieces.withColumn("grp", starts).withColumn("grp", F.sum("grp").over(before.rowsBetween(Window.unboundedPreceding, 0)))


def gap_runs(rows: DataFrame, keys: list[str], gap_s: float, stretch_s: float | None = None) -> DataFrame:
    """``rows`` (``keys, ts, tie``) with ``grp``, which grows by one where more than ``gap_s`` has passed since the row before, stitched over stretches of time."""
    s, pieces, cell = pieces_of_runs(rows, keys, gap_s, stretch_s)
    return placed_runs(s, pieces, cell)


def placed_runs(s: DataFrame, pieces: DataFrame, cell: list[str]) -> DataFrame:
    base = pieces.groupBy(*cell).agg(F.min("grp").alias("__base"))
    return s.join(base, cell).withColumn("grp", F.col("__base") + F.col("__run")).drop("__run", "__base", "__part")


def numbered(rows: DataFrame, keys: list[str], stretch_s: float = 86_400.0) -> DataFrame:
    """``rows`` (``keys, ts, tie``) with ``row_no`` from 0 by time and tie within their keys, numbered per stretch of time and shifted by the rows before it."""
    s, cell = in_stretches(rows, keys, stretch_s)
    n = s.groupBy(*cell).agg(F.count("*").alias("n"))
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    n = n.select(*cell, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__base"))
    s = s.withColumn("__own", F.row_number().over(Window.partitionBy(*cell).orderBy("ts", "tie")) - 1)
    return s.join(n, cell).withColumn("row_no", (F.col("__base") + F.col("__own")).cast("long")).drop("__own", "__base", "__part")


def gap_windows(samples: DataFrame, gap_s: float = 0.5, min_len: int = 100, split_by_date: bool = True, dates: list[str] | None = None, by: str | None = None) -> DataFrame:
    """``sig_key, win_idx, start_ts, end_ts, n, longest, signal, seconds`` of runs without a gap above ``gap_s``.

    No run passes midnight if ``split_by_date``, or from one value of the column ``by`` to another if that is given instead.
    Windows are numbered by time; before that by the place of their date in ``dates``, or by ``by``.
    Numbers, and ``longest``, the most samples of any window of the signal, are made from one narrow row a window.
    """
    split_by_date = split_by_date and by is None
    keys = ["sig_key"] + (["date"] if split_by_date else [by] if by else [])
    s = samples.select("sig_key", "ts", "tie", "signal", *([by] if by else []))
    s = in_runs(s.withColumn("date", F.to_date("ts")) if split_by_date else s, keys, gap_s)
    named = [*keys, "__part", "__run"]
    # Samples are shuffled once, to their stretch; from there on they travel as one array a piece, written for the runs and the windows.
    pieces = s.groupBy(*named).agg(F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"), F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("ts", "tie", "signal"))).alias("a"))
    pieces = staged(pieces.withColumn("a", F.transform("a", lambda x: F.struct(F.unix_micros(x["ts"].cast("timestamp")).alias("at"), x["signal"].cast("double").alias("signal")))))
    grouped = with_groups(pieces.drop("a"), keys, gap_s)
    runs = grouped.groupBy(*keys, "grp").agg(F.min("start_ts").alias("start_ts"), F.max("end_ts").alias("end_ts"), F.sum("n").alias("n")).where(F.col("n") >= min_len)
    place = [F.array_position(F.array(*map(F.lit, dates)), F.col("date").cast("string"))] if dates and split_by_date else [by] if by else []
    own = Window.partitionBy("sig_key")
    runs = runs.withColumn("win_idx", (F.row_number().over(own.orderBy(*place, "start_ts")) - 1).cast("long")).withColumn("longest", F.max("n").over(own))
    w = pieces.select(*named, "a").join(grouped.select(*named, "grp"), named)
    w = w.groupBy(*keys, "grp").agg(F.flatten(F.array_sort(F.collect_list(F.struct("__part", "__run", "a")))["a"]).alias("a"))
    w = runs.join(w, [*keys, "grp"])
    first = F.unix_micros(F.col("start_ts").cast("timestamp"))
    w = w.withColumn("signal", F.transform("a", lambda x: x["signal"])).withColumn("seconds", F.transform("a", lambda x: (x["at"] - first) / 1e6))
    return w.select("sig_key", "win_idx", "start_ts", "end_ts", "n", "longest", "signal", "seconds")


def centre_pad(windows: DataFrame) -> DataFrame:
    """Subtract the mean, then fill with zeros to the signal's longest window; times go on at the first step.

    The longest is told by the column ``longest`` where there is one, else by a grouped maximum of the sizes alone, joined to the windows.
    """
    mean = F.aggregate("signal", F.lit(0.0), lambda a, x: a + x) / F.size("signal")
    w = windows.withColumn("__m", mean)
    if "longest" in windows.columns:
        w = w.withColumn("__n", F.col("longest").cast("int")).drop("longest")
    else:
        w = w.join(windows.groupBy("sig_key").agg(F.max(F.size("signal")).alias("__n")), "sig_key")
    more = F.col("__n") - F.size("signal")
    step = F.coalesce(F.get("seconds", F.lit(1)) - F.get("seconds", F.lit(0)), F.lit(0.0))
    last = F.element_at("seconds", -1)
    tail = F.when(more > 0, F.transform(F.sequence(F.lit(1), more), lambda k: last + k * step)).otherwise(F.array().cast("array<double>"))
    # Lengthened before the signal is, from whose size it is told.
    w = w.withColumn("seconds", F.concat("seconds", tail))
    w = w.withColumn("signal", F.concat(F.transform("signal", lambda x: x - F.col("__m")), F.array_repeat(F.lit(0.0), more)))
    return w.drop("__m", "__n")


def segment_range(windows: DataFrame, n_segments: int = 10, threshold: float = 55.0) -> DataFrame:
    """``mean_range`` of equal segments (the rest is dropped) and ``is_anomaly`` where it is above the threshold."""
    size = F.floor(F.size("signal") / n_segments).cast("int")
    part = lambda k: F.slice("signal", k * size + 1, size)
    total = F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(n_segments - 1)), lambda k: F.array_max(part(k)) - F.array_min(part(k))), F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
    w = windows.withColumn("mean_range", total / n_segments)
    return w.withColumn("is_anomaly", F.col("mean_range") > threshold)


def two_sided(windows: DataFrame, threshold: float = 0.0) -> DataFrame:
    """``has_peak``: the greatest value and the size of the least both reach the threshold."""
    return windows.withColumn("has_peak", (F.array_max("signal") >= threshold) & (F.abs(F.array_min("signal")) >= threshold))


def energy(windows: DataFrame, size: int = 5) -> DataFrame:
    """Sum of absolute values after a median filter; edges repeat the outermost sample."""
    n, half = F.size("signal"), size // 2
    at = lambda i: F.element_at("signal", F.greatest(F.lit(1), F.least(n, i)))
    median = F.transform(F.sequence(F.lit(1), n), lambda i: F.abs(F.sort_array(F.array(*(at(i + d) for d in range(-half, half + 1))))[half]))
    return windows.withColumn("energy", F.when(n > 0, F.aggregate(median, F.lit(0.0), lambda a, x: a + x)).otherwise(F.lit(0.0)))
