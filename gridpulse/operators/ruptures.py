"""Ruptures: lasting changes of level in long series, found in blocks with halos.

The derivative of the rolling median at a row is the median of the ``half`` values from it
on less that of the ``half`` before. Candidates are its local extremes; a 2-means cut over
all candidates of a signal keeps the steep ones; binary segmentation around each one finds
the row that parts its surroundings best.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.operators.windows import numbered
from gridpulse.sources.stage import staged

SCHEMA = "sig_key string, at long, steep double, row_no long, jump double, gain double"


def derivative(x: np.ndarray, half: int) -> np.ndarray:
    """Median of the next ``half`` values less that of the last ``half``, where both are whole; else NaN."""
    out = np.full(len(x), np.nan)
    if len(x) >= 2 * half:
        m = np.median(np.lib.stride_tricks.sliding_window_view(x, half), axis=1)
        out[half : len(x) - half + 1] = m[half:] - m[:-half]
    return out


def extremes(d: np.ndarray, half: int) -> np.ndarray:
    """Rows whose absolute derivative is not zero, nor less than any within ``half`` rows, nor equal to an earlier one there."""
    a = np.where(np.isnan(d), 0.0, np.abs(d))
    wide = np.pad(a, half)
    v = np.lib.stride_tricks.sliding_window_view(wide, 2 * half + 1)
    before, after = v[:, :half].max(1), v[:, half + 1 :].max(1)
    return np.flatnonzero((a > 0) & (a > before) & (a >= after))


def split(x: np.ndarray, least: int) -> tuple[int, float, float]:
    """Where ``x`` is best parted in two with ``least`` values a side: the place, the step of the means and the squares saved."""
    n = len(x)
    y = x - x[0]
    k = np.arange(least, n - least + 1)
    left = np.cumsum(y)[k - 1]
    total = y.sum()
    gain = left**2 / k + (total - left) ** 2 / (n - k) - total**2 / n
    i = int(gain.argmax())
    return int(k[i]), float((total - left[i]) / (n - k[i]) - left[i] / k[i]), float(gain[i])


def candidates(rows: DataFrame, half: int = 30, reach: int = 120, block: int = 250_000) -> DataFrame:
    """Per candidate of ``sig_key, ts, tie, value``: its row ``at``, ``steep``, and ``row_no, jump, gain`` of the best split within ``reach`` rows.

    Rows go to the block of their number and to a neighbour that they are a halo of; a
    candidate is told by the block that owns it from what lies within the halo alone, so
    block edges do not show. Null values are left out.
    """
    halo = max(3 * half, half + reach)
    if block < halo:
        raise ValueError(f"blocks of {block} rows are shorter than their halo of {halo}")
    own = F.floor(F.col("row_no") / block).cast("long")
    r = numbered(rows.where("value is not null").select("sig_key", "ts", "tie", F.col("value").cast("double").alias("value")), ["sig_key"])
    near = F.array_distinct(F.array(own, F.floor((F.col("row_no") - halo) / block).cast("long"), F.floor((F.col("row_no") + halo) / block).cast("long")))
    r = r.select("sig_key", "row_no", "value", F.explode(near).alias("block")).where("block >= 0")

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row_no")
        no, x = pdf["row_no"].to_numpy(), pdf["value"].to_numpy()
        d = derivative(x, half)
        out = []
        for i in extremes(d, half):
            if no[i] // block == key[1]:
                lo, hi = max(0, i - reach), min(len(x), i + reach)
                k, jump, gain = split(x[lo:hi], max(2, half // 2))
                out.append((key[0], no[i], abs(d[i]), no[lo + k], jump, gain))
        return pd.DataFrame(out, columns=["sig_key", "at", "steep", "row_no", "jump", "gain"])

    return r.groupBy("sig_key", "block").applyInPandas(run, SCHEMA)


def steep_ones(found: DataFrame, separation: float, rounds: int = 30) -> DataFrame:
    """Candidates in the upper of two clusters of ``steep`` per signal, where its mean is ``separation`` times the lower one's.

    The means start from the least and the greatest value and are moved by grouped averages
    until they stay; between rounds only two numbers a signal come to the driver.
    """
    spark = found.sparkSession
    upper = F.abs(F.col("steep") - F.col("high")) < F.abs(F.col("steep") - F.col("low"))
    means = {r["sig_key"]: (r["low"], r["high"]) for r in found.groupBy("sig_key").agg(F.min("steep").alias("low"), F.max("steep").alias("high")).collect()}
    table = lambda: spark.createDataFrame([(k, *v) for k, v in means.items()], "sig_key string, low double, high double")
    for _ in range(rounds):
        moved = found.join(table(), "sig_key").groupBy("sig_key").agg(F.avg(F.when(~upper, F.col("steep"))).alias("low"), F.avg(F.when(upper, F.col("steep"))).alias("high"))
        now = {r["sig_key"]: tuple(x if x is not None else y for x, y in zip((r["low"], r["high"]), means[r["sig_key"]])) for r in moved.collect()}
        if now == means:
            break
        means = now
    kept = found.join(table(), "sig_key").where(upper & (F.col("high") >= separation * F.greatest("low", F.lit(1e-9))))
    return kept.drop("low", "high")


def ruptures(rows: DataFrame, half: int = 30, reach: int = 120, separation: float = 3.0, block: int = 250_000) -> DataFrame:
    """``sig_key, row_no, jump, gain``: the first row of each new level, once each, with the step of the means and the squares it saves."""
    steep = steep_ones(staged(candidates(rows, half, reach, block)), separation)
    return steep.groupBy("sig_key", "row_no").agg(F.max_by("jump", "gain").alias("jump"), F.max("gain").alias("gain"))
