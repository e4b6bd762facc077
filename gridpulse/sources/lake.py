"""Text captures to a partitioned Parquet lake, and back."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

METRICS = ("min", "max", "moy", "efficace")
VALUES = {"oscillo": ["v1", "v2", "v3"], "TRMS": [f"{m}{v}" for v in (1, 2, 3) for m in METRICS]}
PARTS = ["kind", "boitier", "voie", "date"]


def with_path(df: DataFrame, path: str = "path") -> DataFrame:
    """``date, boitier, kind`` from the path; today and an unknown device where it names none."""
    p = F.col(path)
    found = F.try_to_date(F.nullif(F.regexp_extract(p, r"\d{4}-\d{2}-\d{2}", 0), F.lit("")))
    kind = F.when(p.contains("TRMS") | F.element_at(F.split(p, "/"), -1).contains("trms"), "TRMS").otherwise("oscillo")
    return df.withColumns({"date": F.coalesce(found, F.current_date()), "boitier": F.coalesce(F.nullif(F.regexp_extract(p, r"boitier_\d+", 0), F.lit("")), F.lit("boitier_inconnu")), "kind": kind})


def parsed_time(text: Column) -> Column:
    """Time without a zone from mixed spellings: ISO with blank or T and any fraction, dates alone, slashes with the year or the month first."""
    t = F.regexp_replace(F.btrim(text), r"^(\d{4})/(\d{1,2})/(\d{1,2})", "$1-$2-$3")
    return F.regexp_replace(t, r"^(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$1-$2").try_cast("timestamp_ntz")


def raw_rows(spark: SparkSession, root: str, kind: str = "oscillo") -> DataFrame:
    """Lines of all ``.txt`` files of a kind with path, ``ts`` (null if it can't be read), values, ``bad_values`` (texts that are no numbers) and ``tie``, their order."""
    names = VALUES[kind]
    raw = spark.read.schema(", ".join(f"{c} string" for c in ["t", *names])).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").csv(root)
    at = F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    raw = with_path(raw.select("*", F.col("_metadata.file_path").alias("path"), at.alias("tie"))).where(F.col("kind") == kind)
    number = lambda c: F.btrim(c).try_cast("float")
    bad = sum((F.col(c).isNotNull() & (F.btrim(c) != "") & number(c).isNull()).cast("int") for c in names)
    raw = raw.withColumn("bad_values", bad).withColumn("ts", parsed_time(F.col("t")))
    return raw.withColumns({c: number(c) for c in names})


def read_text(spark: SparkSession, root: str, kind: str = "oscillo") -> DataFrame:
    """Rows ``ts`` and values of all ``.txt`` files of a kind, one row per channel ``voie``; ``rejected`` has the lines left out."""
    raw = raw_rows(spark, root, kind).where("ts is not null")
    return unpivot(raw, kind).select("kind", "boitier", "voie", "date", "ts", "tie", "path", *(("signal",) if kind == "oscillo" else METRICS))


def rejected(spark: SparkSession, root: str, kind: str = "oscillo") -> DataFrame:
    """``path, t``: lines whose time can't be read."""
    return raw_rows(spark, root, kind).where("ts is null").select("path", "t")


def file_status(spark: SparkSession, root: str, kind: str = "oscillo") -> DataFrame:
    """Per file ``path, lines, bad, bad_values, status``: 'ok', 'partial' (some lines or values can't be read), or 'failed' where no line can."""
    n = raw_rows(spark, root, kind).groupBy("path").agg(F.count("*").alias("lines"), F.count(F.when(F.col("ts").isNull(), 1)).alias("bad"), F.sum("bad_values").alias("bad_values"))
    return n.withColumn("status", F.when(F.col("bad") == F.col("lines"), "failed").when((F.col("bad") > 0) | (F.col("bad_values") > 0), "partial").otherwise("ok"))


def read_loose(spark: SparkSession, root: str, channel: int = 0) -> DataFrame:
    """``sig_key, file, ts, tie, signal`` of loose ``.txt`` and ``.csv`` files: one signal, named by the folder.

    Windows are cut per ``file`` and numbered in the order of their paths, so that chains,
    padding and types run over all files, and a file may pass midnight. The separator is the one of comma, semicolon, tab, bar and blank that is most
    common in a file's first line; column 0 is the time; the channel counts columns
    in which every value is a number. A file with a time that can't be read, or with too few
    such columns, contributes nothing.
    """
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{txt,csv}").text(root)
    at = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    lines = lines.select(F.col("_metadata.file_path").alias("path"), at.alias("tie"), F.btrim("value", F.lit(" \r\n")).alias("value")).where("value <> ''")
    # A blank inside a time is no separator as long as another one occurs.
    count = lambda sep: F.size(F.split("head", F.concat(F.lit("\\Q"), F.lit(sep), F.lit("\\E")))) - 1
    marks = F.array(*(F.struct(F.when(F.lit(sep) == " ", F.least(count(sep), F.lit(0))).otherwise(count(sep)).alias("n"), F.lit(-k).alias("k"), F.lit(sep).alias("sep")) for k, sep in enumerate((",", ";", "\t", "|", " "))))
    heads = lines.groupBy("path").agg(F.min_by("value", "tie").alias("head")).select("path", F.array_max(marks)["sep"].alias("sep"))
    cells = lines.join(heads, "path").select("path", "tie", F.split("value", F.concat(F.lit("\\Q"), F.col("sep"), F.lit("\\E"))).alias("v")).withColumn("ts", parsed_time(F.get("v", F.lit(0))))
    good = cells.groupBy("path").agg(F.bool_and(F.col("ts").isNotNull()).alias("ok")).where("ok").select("path")
    columns = cells.join(good, "path", "left_semi").select("path", F.posexplode("v").alias("pos", "x")).where("pos > 0")
    columns = columns.groupBy("path", "pos").agg(F.bool_and((F.btrim("x") == "") | F.btrim("x").try_cast("double").isNotNull()).alias("number")).where("number")
    own = columns.withColumn("k", F.row_number().over(Window.partitionBy("path").orderBy("pos")) - 1).where(F.col("k") == channel).select("path", "pos")
    out = cells.join(own, "path").select(F.lit(root.rstrip("/").rsplit("/", 1)[-1]).alias("sig_key"), F.col("path").alias("file"), "ts", "tie", F.btrim(F.get("v", F.col("pos"))).try_cast("double").alias("signal"))
    return out.where("signal is not null")


def unpivot(wide: DataFrame, kind: str = "oscillo") -> DataFrame:
    if kind == "oscillo":
        rows = [F.struct(F.lit(v).alias("voie"), F.col(f"v{v}").alias("signal")) for v in (1, 2, 3)]
    else:
        rows = [F.struct(F.lit(v).alias("voie"), *(F.col(f"{m}{v}").alias(m) for m in METRICS)) for v in (1, 2, 3)]
    return wide.select("*", F.inline(F.array(*rows)))


def merge(new: DataFrame, existing: DataFrame | None, keys: list[str], dedup_on_create: bool = False) -> DataFrame:
    """``new`` and ``existing`` rows with ``row_no``, their place among rows of one time.

    Whether a write is the first is decided per target, that is per value of ``keys``: a
    target that holds nothing yet keeps all rows (the first of each time if
    ``dedup_on_create``); of one that exists the first row of each time stays, its own rows
    before new ones, and those in the order in which they were written (``row_no``).
    """
    both = new.withColumns({"__src": F.lit(1), "__known": F.lit(dedup_on_create), "__was": F.lit(None).cast("int")})
    if existing is not None:
        known = existing.select(*keys).distinct().withColumn("__k", F.lit(True))
        both = both.join(known, keys, "left").withColumn("__known", F.col("__known") | F.coalesce("__k", F.lit(False))).drop("__k")
        was = F.col("row_no") if "row_no" in existing.columns else F.lit(None)
        old = existing.withColumns({"__src": F.lit(0), "__known": F.lit(True), "__was": was.cast("int")}).drop("row_no")
        both = old.unionByName(both, allowMissingColumns=True)
    order = Window.partitionBy(*keys, "ts").orderBy("__src", "__was", "tie")
    both = both.withColumn("row_no", F.row_number().over(order)).where(~F.col("__known") | (F.col("row_no") == 1))
    return both.drop("__src", "__known", "__was")


def write(rows: DataFrame, path: str) -> None:
    """Partitions by kind, device, channel and date, rows in order of time and ``row_no``; only partitions that have new rows are replaced."""
    order = ["ts"] + [c for c in ("row_no", "tie") if c in rows.columns]
    out = rows.repartition(*PARTS).sortWithinPartitions(*PARTS, *order).drop("tie", "path")
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy").partitionBy(*PARTS).parquet(path)


def scan(spark: SparkSession, path: str, boitier: str, voie: int, dates: list[str], kind: str = "oscillo") -> DataFrame:
    """Partitions of a signal; a date that is missing raises ``FileNotFoundError``."""
    out = spark.read.parquet(path).where((F.col("kind") == kind) & (F.col("boitier") == boitier) & (F.col("voie") == voie) & F.col("date").cast("string").isin(*dates))
    missing = sorted(set(dates) - {str(r["date"]) for r in out.select("date").distinct().collect()})
    if missing:
        raise FileNotFoundError(f"no data of {boitier}/voie_{voie} on {', '.join(missing)}")
    return out


PROFILE = (
    "signal_id string, events array<struct<event_id: int, cluster_id: int, type_label: string, ref_timestamp: timestamp_ntz, ref_dom_freq: double, ref_dom_freqs4: array<double>, "
    "window_timestamps: array<timestamp_ntz>, ncc_vs_ref: array<double>, dom_freqs: array<double>, window_count: int, duration_s: double>>, total_windows long, n_clusters int, t_start timestamp_ntz, t_end timestamp_ntz"
)


def write_profile(profile: DataFrame, path: str) -> None:
    """Profiles as JSON, one line a signal; windows and peaks stay in memory."""
    names = [f.name for f in T.StructType.fromDDL(PROFILE)["events"].dataType.elementType]
    kept = profile.withColumn("events", F.transform("events", lambda e: F.struct(*(e[n].alias(n) for n in names))))
    kept.write.mode("overwrite").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)


def read_profile(spark: SparkSession, path: str, schema=PROFILE) -> DataFrame:
    """Profiles from JSON; a span that is missing comes from the events."""
    p = spark.read.schema(schema).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]").json(path)
    first = F.array_min(F.transform("events", lambda e: e["ref_timestamp"]))
    last = F.array_max(F.transform("events", lambda e: F.element_at(e["window_timestamps"], -1)))
    return p.withColumns({"t_start": F.coalesce("t_start", first), "t_end": F.coalesce("t_end", last)})


def write_type_windows(windows: DataFrame, path: str) -> None:
    """``sig_key, cid, window`` as Parquet by signal."""
    windows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("sig_key").parquet(path)


def existing(spark: SparkSession, path: str, parts: DataFrame) -> DataFrame | None:
    """Rows of the lake in the partitions ``parts``; ``None`` where there is no lake yet."""
    try:
        rows = spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None
    return rows.join(parts, parts.columns, "left_semi")


def write_aside(rows: DataFrame, path: str) -> None:
    """``write`` of rows that partly come from ``path``: they are written beside it first, so a lost executor re-reads files that no one replaces."""
    spark = rows.sparkSession
    aside = f"{path.rstrip('/')}-aside-{uuid.uuid4().hex}"
    rows.write.parquet(aside)
    write(spark.read.parquet(aside), path)
    where = spark._jvm.org.apache.hadoop.fs.Path(aside)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
