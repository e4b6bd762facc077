"""HTML reports as text files, put together by Spark: one folder a signal, one for the correlation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.operators import profiles as P
from gridpulse.operators import reports as R

HEAD = "<!doctype html><meta charset=utf-8><style>td,th{padding:2px 8px;border:1px solid #ccc}svg{background:#fafafa}</style>"
#: A curve is drawn with at most so many points, each the greatest of its stretch.
POINTS, WIDTH, HEIGHT = 300, 360, 90


def escaped(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c.cast("string"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def row(*cells: Column) -> Column:
    return F.concat(F.lit("<tr>"), *(F.concat(F.lit("<td>"), F.coalesce(c, F.lit("")), F.lit("</td>")) for c in cells), F.lit("</tr>"))


def curve(signal: str, color: Column) -> Column:
    """An inline drawing of an array."""
    n = F.size(signal)
    each = F.greatest(F.lit(1), F.ceil(n / POINTS)).cast("int")
    top = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(n / each) - 1, F.lit(0)).cast("int")), lambda k: F.array_max(F.slice(signal, k * each + 1, each)))
    low, high = F.array_min(signal), F.array_max(signal)
    y = lambda v: F.round(HEIGHT * (high - v) / F.when(high > low, high - low).otherwise(F.lit(1.0)), 1)
    points = F.array_join(F.transform(top, lambda v, i: F.concat_ws(",", F.round(i * WIDTH / F.greatest(F.size(top), F.lit(1)), 1), y(v))), " ")
    svg = F.concat(F.lit(f"<svg width={WIDTH} height={HEIGHT}><polyline fill=none stroke=\""), color, F.lit("\" points=\""), points, F.lit("\"/></svg>"))
    return F.when(n > 0, svg).otherwise("")


def bars(counts: str, color: Column) -> Column:
    """An inline drawing of an array of counts."""
    n, top = F.greatest(F.size(counts), F.lit(1)), F.greatest(F.array_max(counts), F.lit(1))
    w = F.lit(float(WIDTH)) / n
    one = lambda v, i: F.when(v > 0, F.format_string(f"<rect x=%.1f y=%.1f width=%.1f height=%.1f />", i * w, HEIGHT * (1 - v / top), F.greatest(w, F.lit(1.0)), HEIGHT * v / top)).otherwise("")
    return F.concat(F.lit(f"<svg width={WIDTH} height={HEIGHT} fill=\""), color, F.lit("\">"), F.array_join(F.transform(counts, one), ""), F.lit("</svg>"))


def colour(cid: str) -> Column:
    return F.get(F.array(*map(F.lit, R.COLOURS)), F.col(cid) % len(R.COLOURS))


def page(parts: DataFrame, title: Column) -> DataFrame:
    """``sig_key, value``: ``part`` and ``html`` of each section in order, rows of a section by ``place``; a page is one line a row."""
    lines = parts.select("sig_key", "part", "place", "html")
    heads = parts.select("sig_key", "part").distinct().select("sig_key", "part", F.lit(-1).cast("long").alias("place"), F.concat(F.when(F.col("part") == 0, F.concat(F.lit(HEAD), F.lit("<h1>"), title, F.lit("</h1>"))).otherwise(""), F.lit("</table><table>")).alias("html"))
    return lines.union(heads).repartition("sig_key").sortWithinPartitions("sig_key", "part", "place").select("sig_key", F.col("html").alias("value"))


def signal_pages(found: DataFrame, minutes: int = 10) -> DataFrame:
    """Lines of one page a signal: its types with reference, occurrence and counts, then its events."""
    spread = R.occurrence(found, minutes).groupBy("sig_key", "cluster_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("bin", "n"))), lambda x: x["n"]).alias("counts"))
    t = R.type_report(found).join(spread, ["sig_key", "cluster_id"], "left").withColumn("counts", F.coalesce("counts", F.array().cast("array<bigint>")))
    text = lambda c: escaped(F.col(c))
    types = t.select("sig_key", F.lit(0).alias("part"), F.col("cluster_id").cast("long").alias("place"), row(text("type_label"), text("n_events"), text("n_windows"), text("first_ts"), curve("ref_window", colour("cluster_id")), bars("counts", colour("cluster_id"))).alias("html"))
    e = P.event_table(found)
    events = e.select("sig_key", F.lit(1).alias("part"), F.col("event_id").cast("long").alias("place"), row(*map(text, ("event_id", "type_label", "ref_timestamp", "window_count", "duration_s", "mean_freq", "mean_ncc"))).alias("html"))
    return page(types.union(events), escaped(F.col("sig_key")))


def correlation_page(pairs: DataFrame, windows: DataFrame) -> DataFrame:
    """Lines of one page of shared pairs, both windows side by side (``windows``: ``sig_key, cid, window``)."""
    a, b = (windows.select(F.col("sig_key").alias(f"sig_key_{k}"), F.col("cid").alias(f"cid_{k}"), F.col("window").cast("array<double>").alias(f"w_{k}")) for k in "ab")
    p = R.pair_color(pairs).join(a, ["sig_key_a", "cid_a"], "left").join(b, ["sig_key_b", "cid_b"], "left")
    text = lambda c: escaped(F.col(c))
    html = row(*map(text, ("pair_idx", "sig_key_a", "cid_a", "count_a", "sig_key_b", "cid_b", "count_b")), F.format_string("%.4f", "ncc"), curve("w_a", F.col("color")), curve("w_b", F.col("color")))
    return page(p.select(F.lit("correlation").alias("sig_key"), F.lit(0).alias("part"), F.col("pair_idx").cast("long").alias("place"), html.alias("html")), F.lit("Shared types"))


def registry_page(types: DataFrame) -> DataFrame:
    """Lines of one page of registry types (``type_id, window``)."""
    t = types.select(F.lit("registry").alias("sig_key"), F.lit(0).alias("part"), F.col("type_id").cast("long").alias("place"), row(F.col("type_id").cast("string"), curve("window", colour("type_id"))).alias("html"))
    return page(t, F.lit("Registry"))


def write(pages: DataFrame, path: str) -> None:
    """A folder for each ``sig_key`` under ``path``, of one text file; a page's lines are written by one task, in order."""
    pages.write.mode("overwrite").partitionBy("sig_key").text(path)
