"""Entry points for ``spark-submit``: ``cli.py ingest | analyse | correlate``.

The job runs all signals it is given at once, so there are no slots or workers to
set: partitions and the scheduler take their place.
"""

from __future__ import annotations

import argparse
import dataclasses
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.operators import correlate as C
from gridpulse.operators import profiles as P
from gridpulse.operators import temporal as T
from gridpulse.sources import lake, pages
from gridpulse.sources.registry import Registry


def session() -> SparkSession:
    return SparkSession.builder.appName("gridpulse").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def ingest(spark: SparkSession, source: str, target: str, kinds: tuple[str, ...] = ("oscillo", "TRMS"), dedup_on_create: bool = False) -> DataFrame:
    """Merge all text files under ``source`` into the lake; the status of every file."""
    parts, status = ["kind", "boitier", "voie", "date"], None
    for kind in kinds:
        where = f"{target}/{kind}"
        new = lake.read_text(spark, source, kind)
        old = lake.existing(spark, where, new.select(*parts).distinct())
        lake.write_aside(lake.merge(new, old, parts, dedup_on_create), where)
        own = lake.file_status(spark, source, kind).withColumn("kind", F.lit(kind))
        status = own if status is None else status.union(own)
    return status


Wanted = tuple[str, int, list[str]]


def signals(spark: SparkSession, target: str, wanted: list[Wanted]) -> DataFrame:
    """Samples ``sig_key, ts, tie, signal`` of several signals (device, channel, dates) from the lake; dates of one signal over all its entries once each.

    A signal without data on one of its dates raises ``FileNotFoundError``.
    """
    days: dict[tuple[str, int], list[str]] = {}
    for boitier, voie, dates in wanted:
        days.setdefault((boitier, voie), []).extend(dates)
    out = None
    for (boitier, voie), dates in days.items():
        rows = lake.scan(spark, f"{target}/oscillo", boitier, voie, list(dict.fromkeys(dates)))
        tie = F.col("row_no").cast("long") if "row_no" in rows.columns else F.monotonically_increasing_id()
        rows = rows.select(F.lit(f"{boitier}/voie_{voie}").alias("sig_key"), "ts", tie.alias("tie"), "signal")
        out = rows if out is None else out.union(rows)
    return out


def analyse(spark: SparkSession, samples: DataFrame, output: str, settings: P.Settings = P.Settings(), registry: str | None = None, registry_threshold: float = 0.8, dates: list[str] | None = None, bins_min: int = 10) -> DataFrame:
    """Profiles, type windows and the event table of all signals in ``samples`` under ``output``; registry ids if a registry is named.

    ``dates`` fixes the order of windows where it is not that of time.
    """
    found = P.analyse(samples, settings, dates)
    found.write.mode("overwrite").parquet(f"{output}/events")
    found = spark.read.parquet(f"{output}/events")
    lake.write_profile(P.profile(found), f"{output}/profile")
    lake.write_type_windows(P.type_windows(found), f"{output}/type_windows")
    P.event_table(found).write.mode("overwrite").parquet(f"{output}/event_table")
    pages.write(pages.signal_pages(found, bins_min), f"{output}/report")
    if registry:
        own = P.arriving_types(found)
        ids = Registry(spark, registry).assign(own, registry_threshold)
        known = spark.createDataFrame(sorted(ids.items()), "name string, type_id int")
        own.join(known, "name").select("sig_key", "cluster_id", "type_id").write.mode("overwrite").parquet(f"{output}/registry_ids")
        pages.write(pages.registry_page(Registry(spark, registry).types()), f"{output}/registry_report")
    return found


def correlate(spark: SparkSession, outputs: list[str], target: str, threshold: float = 0.8, corr_window_s: float = 30.0) -> DataFrame | None:
    """Shared types over the outputs of several analyses (one a day, say); unreadable ones are named and left out.

    Beside ``target``, ``target``-cooccurrence gets the types whose events come within ``corr_window_s`` of each other in different signals.
    """
    found = windows = None
    for day, path in enumerate(outputs):
        try:
            e, w = spark.read.parquet(f"{path}/events"), spark.read.parquet(f"{path}/type_windows").withColumn("day", F.lit(day))
        except Exception as problem:  # noqa: BLE001
            print(f"{path}: {type(problem).__name__}", file=sys.stderr)
            continue
        found = e if found is None else found.unionByName(e)
        windows = w if windows is None else windows.unionByName(w)
    pairs = None if found is None else C.correlate(found, windows, threshold)
    if pairs is not None:
        pairs.write.mode("overwrite").parquet(target)
        pairs = spark.read.parquet(target)
        pages.write(pages.correlation_page(pairs, windows.groupBy("sig_key", "cid").agg(F.min_by("window", "day").alias("window"))), f"{target}-report")
        together = found.select("sig_key", F.concat_ws("/", "sig_key", F.col("cluster_id").cast("string")).alias("cid"), "event_id", F.col("ref_timestamp").alias("ts"))
        T.cooccurrence(together, corr_window_s).write.mode("overwrite").parquet(f"{target}-cooccurrence")
    return pairs


def named_signal(text: str) -> Wanted:
    boitier, voie, dates = text.split(":")
    return boitier, int(voie), dates.split(",")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="gridpulse")
    sub = top.add_subparsers(dest="job", required=True)
    p = sub.add_parser("ingest")
    p.add_argument("--source", required=True)
    p.add_argument("--lake", required=True)
    p.add_argument("--dedup-on-create", action="store_true")
    p = sub.add_parser("analyse")
    p.add_argument("--lake")
    p.add_argument("--files", help="a folder of loose files in place of the lake")
    p.add_argument("--channel", type=int, default=0)
    p.add_argument("--boitier", default="boitier_1")
    p.add_argument("--voie", type=int, default=1)
    p.add_argument("--dates", nargs="+", default=[])
    p.add_argument("--signal", action="append", type=named_signal, default=[], help="boitier:voie:date[,date...], once for each signal; in place of the three above")
    p.add_argument("--no-split-by-date", dest="split_by_date", action="store_false")
    p.add_argument("--output", required=True)
    p.add_argument("--registry")
    p.add_argument("--registry-threshold", type=float, default=0.8)
    p.add_argument("--bins-min", type=int, default=10, help="minutes of a bin in the report of types")
    for f in dataclasses.fields(P.Settings):
        if f.type != "bool":
            p.add_argument("--" + f.name.replace("_", "-"), type={"int": int, "float": float}[f.type], default=f.default)
    p = sub.add_parser("correlate")
    p.add_argument("--outputs", nargs="+", required=True)
    p.add_argument("--target", required=True)
    p.add_argument("--threshold", type=float, default=0.8)
    p.add_argument("--corr-window-s", type=float, default=30.0)
    return top


def main(argv: list[str] | None = None) -> int:
    """0, or 1 if fewer than two signals can be correlated or nothing could be read."""
    a, spark = parser().parse_args(argv), session()
    if a.job == "ingest":
        status = ingest(spark, a.source, a.lake, dedup_on_create=a.dedup_on_create)
        status.orderBy("path").show(1000, False)
        return 0
    if a.job == "analyse":
        s = P.Settings(**{f.name: getattr(a, f.name) for f in dataclasses.fields(P.Settings)})
        wanted = a.signal or [(a.boitier, a.voie, a.dates)]
        samples = lake.read_loose(spark, a.files, a.channel) if a.files else signals(spark, a.lake, wanted)
        # All signals are numbered by one order of dates; where they name the same dates in different orders, the first counts.
        analyse(spark, samples, a.output, s, a.registry, a.registry_threshold, None if a.files else list(dict.fromkeys(d for *_, dates in wanted for d in dates)), a.bins_min)
        return 0
    return int(correlate(spark, a.outputs, a.target, a.threshold, a.corr_window_s) is None)


if __name__ == "__main__":
    sys.exit(main())
