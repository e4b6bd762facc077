"""Event chains over a stream of windows: keyed state, closed by the watermark."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from gridpulse.functions.signal import ncc_bounded
from gridpulse.streaming.sessions import with_event_time, zone_free

EVENT = "sig_key string, event_idx bigint, first_ts timestamp_ntz, last_ts timestamp_ntz, window_count bigint, ref_ts timestamp_ntz"
WINDOW = "us bigint, regular boolean, top double, shape array<double>"
OPEN = "idx bigint, first bigint, last bigint, n bigint, ref bigint, top double"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Chain(StatefulProcessor):
    """Per signal: windows that the watermark has not passed, the last one that it has, and the open event."""

    def __init__(self, threshold: float, max_lag: int, idle_us: int) -> None:
        self.threshold, self.max_lag, self.idle_us = threshold, max_lag, idle_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", WINDOW)
        self.last = handle.getValueState("last", WINDOW)
        self.open = handle.getValueState("open", OPEN)
        self.given = handle.getValueState("given", "n bigint")

    def ended(self, key: tuple) -> list[tuple]:
        if not self.open.exists():
            return []
        idx, first, last, n, ref, _ = self.open.get()
        self.open.clear()
        t = lambda us: pd.Timestamp(us, unit="us")
        return [(key[0], idx, t(first), t(last), n, t(ref))]

    def step(self, key: tuple, us: int, regular: bool, top: float, shape: list[float]) -> list[tuple]:
        """Take the next window in order: into the open event, or into a new one."""
        out: list[tuple] = []
        was = self.last.get() if self.last.exists() else None
        if was and us - was[0] > self.idle_us:
            out, was = self.ended(key), None
        if regular:
            same = was is not None and was[1] and self.similar(was[3], shape)
            if not same:
                out += self.ended(key)
                n = self.given.get()[0] if self.given.exists() else 0
                self.given.update((n + 1,))
                self.open.update((n, us, us, 1, us, top))
            else:
                idx, first, _, n, ref, best = self.open.get()
                self.open.update((idx, first, us, n + 1, us if top > best else ref, max(top, best)))
        else:
            out += self.ended(key)
        self.last.update((us, regular, top, shape))
        return out

    def similar(self, a: list[float], b: list[float]) -> bool:
        n = min(len(a), len(b))
        return bool(n and ncc_bounded(np.array([a[:n]], float), np.array([b[:n]], float), self.max_lag)[0] >= self.threshold)

    def table(self, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["sig_key", "event_idx", "first_ts", "last_ts", "window_count", "ref_ts"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for b in rows:
            for us, regular, top, shape in zip(b["us"], b["regular"], b["top"], b["shape"]):
                self.waiting.appendValue((int(us), bool(regular), float(top), [float(v) for v in shape]))
                self.handle.registerTimer(int(us) // 1000 + 1)
        yield self.table([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """In order of time, all windows up to the watermark; then the open event, if it has been idle for long enough."""
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        held = sorted((tuple(w) for w in self.waiting.get()), key=lambda w: w[0]) if self.waiting.exists() else []
        out: list[tuple] = []
        for w in held:
            if w[0] < mark:
                out += self.step(key, *w)
                self.handle.registerTimer((w[0] + self.idle_us) // 1000 + 1)
        later = [w for w in held if w[0] >= mark]
        if len(later) < len(held):
            self.waiting.clear()
            if later:
                self.waiting.put(later)
        if not later and self.last.exists() and self.last.get()[0] + self.idle_us < mark:
            out += self.ended(key)
            self.last.clear()
        yield self.table(out)


def chain_events(windows: DataFrame, threshold: float = 0.8, max_lag: int = 5000, idle_s: float = 86_400.0, late: str = "10 minutes", by: str = "signal") -> DataFrame:
    """Events of a stream of windows ``sig_key, start_ts, regular, signal`` (and ``by``, what is compared), as they close.

    A window joins the event of its predecessor in time if both are regular and similar; an
    event closes at the next window that does not join, or when nothing has come for
    ``idle_s``. Windows wait until the watermark has passed them, so the order in which they
    arrive and the micro-batches do not matter; later ones are dropped. Start times of
    a signal are distinct. The session's state store must be RocksDB (``use_state``).
    """
    w = with_event_time(windows, "start_ts", late)
    w = w.select("sig_key", "__at", zone_free("start_ts").alias("us"), F.coalesce("regular", F.lit(False)).alias("regular"), F.array_max("signal").cast("double").alias("top"), F.col(by).cast("array<double>").alias("shape"))
    return w.groupBy("sig_key").transformWithStateInPandas(Chain(threshold, max_lag, round(idle_s * 1e6)), EVENT, "append", "eventtime")


def use_state(spark: SparkSession) -> None:
    """Keep the state of later queries of this session in RocksDB, as timers need it."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
