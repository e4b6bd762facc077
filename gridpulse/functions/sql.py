"""The engine's functions and tables under SQL names."""

from __future__ import annotations

from pyspark.sql import SparkSession

from gridpulse.functions import signal as S
from gridpulse.functions import tables


def register(spark: SparkSession, cutoff_hz: float = 1_000.0, search_width: int = 50, separation: float = 400.0) -> None:
    """``ncc``, ``ncc_full``, ``dominant_frequencies``, ``low_pass``, ``peak_count``, ``shape`` and the table functions for use in ``spark.sql``."""
    tables.register(spark)
    spark.udf.register("shape", S.shape_udf())
    spark.udf.register("ncc", S.ncc_udf(False))
    spark.udf.register("ncc_full", S.ncc_udf(True))
    spark.udf.register("dominant_frequencies", S.spectrum_udf(4))
    spark.udf.register("low_pass", S.low_pass_udf(cutoff_hz))
    spark.udf.register("peak_count", S.peaks_udf(search_width, separation))


def views(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """A temporary view for each table of an analysis under ``path``; the names."""
    names = []
    for table in ("events", "event_table", "type_windows"):
        spark.read.parquet(f"{path}/{table}").createOrReplaceTempView(f"{prefix}{table}")
        names.append(f"{prefix}{table}")
    return names
