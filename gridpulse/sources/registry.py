"""A registry of types that several runs may extend at once.

The registry is a folder of numbered commits; each is one Parquet file with the types it
adds, and comes into being in one step if no other has its number. A run that finds its
number taken reads what the others added, decides again and tries the next one, so no
id is given twice and no lock is held. What is in a commit never changes.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.functions.signal import ncc_full
from gridpulse.operators.events import nearest_type

SCHEMA = pa.schema([("type_id", pa.int32()), ("window", pa.list_(pa.float32()))])
Type = tuple[int, list[float]]


class Conflict(Exception):
    """Another run has taken the number of a commit."""


class Registry:
    """``path`` is any folder that Spark can read."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.jvm = spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self.jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(self.conf)

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def versions(self) -> list[int]:
        """Numbers of all commits, ascending."""
        where = self.jvm.org.apache.hadoop.fs.Path(self.path)
        if not self.fs.exists(where):
            return []
        names = [f.getPath().getName() for f in self.fs.listStatus(where)]
        return sorted(int(n[1:-8]) for n in names if n.startswith("v") and n.endswith(".parquet") and n[1:-8].isdigit())

    def types(self, version: int | None = None, since: int = 0) -> DataFrame:
        """``type_id, window`` of the commits after ``since`` up to ``version`` (all by default)."""
        files = [f"{self.path}/v{v:012d}.parquet" for v in self.versions() if v > since and (version is None or v <= version)]
        if not files:
            return self.spark.createDataFrame([], "type_id int, window array<float>")
        return self.spark.read.schema("type_id int, window array<float>").parquet(*files)

    def ids(self, version: int | None = None) -> list[int]:
        """Ids of all types, ascending."""
        return sorted(r["type_id"] for r in self.types(version).select("type_id").collect())

    def commit(self, base: int, new: list[Type]) -> int:
        """Add ``new`` types as the commit after ``base``; raises ``Conflict`` if there is one already."""
        sink = pa.BufferOutputStream()
        pq.write_table(pa.table({"type_id": [t for t, _ in new], "window": [list(map(float, w)) for _, w in new]}, SCHEMA), sink)
        target, draft = self.at(f"v{base + 1:012d}.parquet"), self.at(f"_draft-{uuid.uuid4().hex}")
        out = self.fs.create(draft, False)
        out.write(bytearray(sink.getvalue().to_pybytes()))
        out.close()
        try:
            if str(self.fs.getUri().getScheme()) == "file":
                # A hard link comes into being whole, or fails where its name is taken.
                local = lambda p: self.jvm.java.nio.file.Paths.get(self.fs.makeQualified(p).toUri())
                self.jvm.java.nio.file.Files.createLink(local(target), local(draft))
            else:
                none = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 1)
                none[0] = self.jvm.org.apache.hadoop.fs.Options.Rename.NONE
                self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf).rename(draft, target, none)
        except Exception as e:
            if "AlreadyExists" in str(getattr(e, "java_exception", e)):
                raise Conflict(str(target)) from e
            raise
        finally:
            self.fs.delete(draft, False)
        return base + 1

    def assign(self, arriving: DataFrame, threshold: float = 0.8, attempts: int = 100) -> dict[str, int]:
        """The type of each row of ``arriving`` (``name, window``, unique names), known or new, in the order of ``name``; new ones are committed.

        Each window takes the best type known by then, the lowest id on ties, or becomes a
        new one. Spark compares all windows with all types of a version; what remains to the
        ordered fold on the driver is to compare them with the types that came since.
        """
        base = max(self.versions(), default=0)
        best = nearest_type(arriving.select(F.col("name").alias("id"), "window"), self.types(base), 0.0)
        rows = arriving.select("name", "window").join(best.withColumnRenamed("id", "name"), "name", "left").orderBy("name")
        arrived = [(r["name"], list(r["window"] or []), (r["ncc"], r["type_id"]) if r["type_id"] is not None else None) for r in rows.toLocalIterator()]
        top, later = max(self.ids(base), default=-1), []
        for _ in range(attempts):
            ids, new = fold(arrived, later, top, threshold)
            if not new:
                return ids
            try:
                self.commit(base, new)
                return ids
            except Conflict:
                version = max(self.versions())
                added = [(r["type_id"], list(r["window"])) for r in self.types(version, base).orderBy("type_id").collect()]
                later, base = later + added, version
                top = max([top, *(t for t, _ in added)])
        raise Conflict(f"{attempts} attempts at {self.path}")


def similarity(a: list[float], b: list[float]) -> float:
    """Full-range similarity over the length of the shorter."""
    n = min(len(a), len(b))
    return float(ncc_full(np.array([a[:n]], float), np.array([b[:n]], float))[0]) if n else 0.0


def fold(arrived: list[tuple[str, list[float], tuple[float, int] | None]], later: list[Type], top: int, threshold: float) -> tuple[dict[str, int], list[Type]]:
    """Types of ``arrived`` (name, window, best score and type so far) against ``later`` types and those that become new in turn, above ``top``."""
    ids, new = {}, []
    for name, window, best in arrived:
        for tid, ref in [*later, *new]:
            s = similarity(window, ref)
            if best is None or s > best[0]:
                best = (s, tid)
        if best is None or best[0] < threshold:
            best = (1.0, top + 1 + len(new))
            new.append((best[1], [float(np.float32(v)) for v in window]))
        ids[name] = best[1]
    return ids, new
