"""Table functions for SQL: windows and chains over partitions of a table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructType, TimestampNTZType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from gridpulse.functions.signal import ncc_bounded

# Schemas are spelled as types, since ``analyze`` runs where no session is.
WINDOWS = (
    StructType().add("sig_key", StringType()).add("win_idx", LongType()).add("start_ts", TimestampNTZType()).add("end_ts", TimestampNTZType())
    .add("n", LongType()).add("signal", ArrayType(DoubleType()))
)
CHAINS = StructType().add("sig_key", StringType()).add("win_idx", LongType()).add("event_idx", LongType()).add("sim", DoubleType())


def needed(table: AnalyzeArgument, columns: list[str]) -> None:
    if not table.isTable:
        raise ValueError("the first argument is a table")
    missing = [c for c in columns if c not in table.dataType.names]
    if missing:
        raise ValueError(f"the table lacks {', '.join(missing)}")


def number(argument: AnalyzeArgument | None, default: float) -> float:
    return default if argument is None or argument.value is None else float(argument.value)


class GapWindows:
    """``gap_windows(TABLE(t) PARTITION BY sig_key ORDER BY ts, gap_s => 0.5, min_len => 100)`` over ``sig_key, ts, signal``.

    The same rows as ``gap_windows`` of the library without a cut at midnight; only the open window is held.
    """

    def __init__(self) -> None:
        self.key, self.index = None, 0
        self.times: list = []
        self.values: list[float] = []
        self.gap, self.least = 0.5, 100

    @staticmethod
    def analyze(table: AnalyzeArgument, gap_s: AnalyzeArgument | None = None, min_len: AnalyzeArgument | None = None) -> AnalyzeResult:
        needed(table, ["sig_key", "ts", "signal"])
        return AnalyzeResult(schema=WINDOWS)

    def eval(self, table, gap_s=0.5, min_len=100):
        self.gap, self.least, self.key = float(gap_s), int(min_len), table["sig_key"]
        if table["ts"] is None:
            return
        # Whole microseconds, as a difference of floats may pass the limit by rounding.
        if self.times and round((table["ts"] - self.times[-1]).total_seconds() * 1e6) > int(self.gap * 1e6):
            yield from self.window()
        self.times.append(table["ts"])
        self.values.append(None if table["signal"] is None else float(table["signal"]))

    def window(self):
        if len(self.times) >= self.least:
            yield self.key, self.index, self.times[0], self.times[-1], len(self.times), self.values
            self.index += 1
        self.times, self.values = [], []

    def terminate(self):
        if self.times:
            yield from self.window()


class EventChain:
    """``event_chain(TABLE(t) PARTITION BY sig_key ORDER BY win_idx, threshold => 0.8, max_lag => 5000)`` over ``sig_key, win_idx, regular, signal``: the event of each regular window."""

    def __init__(self) -> None:
        self.was, self.index = None, -1

    @staticmethod
    def analyze(table: AnalyzeArgument, threshold: AnalyzeArgument | None = None, max_lag: AnalyzeArgument | None = None) -> AnalyzeResult:
        needed(table, ["sig_key", "win_idx", "regular", "signal"])
        if not 0 <= number(threshold, 0.8) <= 1:
            raise ValueError("the threshold is from 0 to 1")
        return AnalyzeResult(schema=CHAINS)

    def eval(self, table, threshold=0.8, max_lag=5000):
        if not table["regular"]:
            self.was = None
            return
        now, sim = np.asarray(table["signal"], float), None
        if self.was is not None:
            n = min(len(now), len(self.was))
            sim = float(ncc_bounded(self.was[None, :n], now[None, :n], int(max_lag))[0])
        if sim is None or sim < float(threshold):
            self.index += 1
        self.was = now
        yield table["sig_key"], table["win_idx"], self.index, sim


def register(spark: SparkSession) -> None:
    """``gap_windows`` and ``event_chain`` for ``SELECT * FROM gap_windows(TABLE(t) PARTITION BY sig_key ORDER BY ts)``."""
    spark.udtf.register("gap_windows", udtf(GapWindows))
    spark.udtf.register("event_chain", udtf(EventChain))
