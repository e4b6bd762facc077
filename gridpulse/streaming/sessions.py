"""Gap windows over a stream, and idempotent re-ingest per micro-batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.sources.lake import existing, merge, write_aside


def zone_free(ts: str) -> Column:
    """Microseconds of a time without a zone, whatever the session's zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', cast({ts} AS TIMESTAMP_NTZ))")


def with_event_time(rows: DataFrame, ts: str, late: str) -> DataFrame:
    """``rows`` with ``__at``, the time ``ts`` as one that a watermark can follow; rows more than ``late`` behind it are dropped by what comes next."""
    return rows.withColumn("__at", F.timestamp_micros(zone_free(ts))).withWatermark("__at", late)


def session_windows(samples: DataFrame, gap_s: float = 0.5, min_len: int = 100, late: str = "10 minutes") -> DataFrame:
    """Windows ``sig_key, start_ts, end_ts, n, mean, low, high`` of ``sig_key, ts, signal``; rows later than the watermark are dropped.

    A session ends when the gap has passed; a gap of exactly ``gap_s`` does not part it.
    """
    gap = f"{int(gap_s * 1_000_000)} microseconds"
    s = with_event_time(samples, "ts", late).groupBy("sig_key", F.session_window("__at", gap).alias("w"))
    out = s.agg(F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"), F.count("*").alias("n"), F.avg("signal").alias("mean"), F.min("signal").alias("low"), F.max("signal").alias("high"))
    return out.where(F.col("n") >= min_len).drop("w")


def ingest(stream: DataFrame, path: str, checkpoint: str):
    """A query that merges each micro-batch into the lake at ``path``, existing rows first."""

    def one(batch: DataFrame, _: int) -> None:
        parts = ["kind", "boitier", "voie", "date"]
        old = existing(batch.sparkSession, path, batch.select(*parts).distinct())
        write_aside(merge(batch, old, parts, dedup_on_create=True), path)

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
