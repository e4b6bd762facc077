"""Exact deduplication of a batch against immutable snapshots screened by binary fuse filters.

A snapshot is its distinct digests in exact buckets, with one static filter per
bucket (three-wise binary fuse, 8-bit fingerprints, about 9 bits a key). Digests
of a batch are screened bucket by bucket: what a filter denies is new, what it
admits joins the exact bucket. New digests are grouped among themselves. All
that share a digest are compared byte by byte with the row that stays.

SHA-256 digests spread evenly, so a bucket holds ``BUCKET`` digests on average
whatever the texts; copies are counted before any shuffle.

Defined cases: null text is empty, and empty texts equal each other; ``doc_id``
is the key; a row whose bytes differ from its digest's first row stands alone.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import WS, cut, only, texts

BUCKET = 200_000
U = np.uint64


def normal(text: Column) -> Column:
    return F.regexp_replace(text, WS, " ")


class FuseFilter:
    """A static filter of 64-bit keys: no false negative, one false positive in 256."""

    def __init__(self, seed: int, segment: int, parts: int, table: np.ndarray) -> None:
        self.seed, self.segment, self.parts, self.table = seed, segment, parts, table

    @staticmethod
    def places(keys: np.ndarray, seed: int, segment: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """Three cells in neighbouring segments, and the fingerprint."""
        h = K.mix(keys + U(seed) * K.BASE)
        first = ((h >> U(32)) * U(parts * segment)) >> U(32)
        low = U(segment - 1)
        at = np.stack([first, (first + U(segment)) ^ ((h >> U(18)) & low), (first + U(2 * segment)) ^ (h & low)])
        return at.astype(np.int64), ((h ^ (h >> U(32))) & U(255)).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> FuseFilter:
        keys = np.unique(keys)
        n = len(keys)
        segment = 1 << max(2, int(math.log(max(n, 2)) / math.log(3.33) + 2.25))
        parts = max(1, math.ceil(max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2))) * n / segment) - 2)
        for seed in range(1, 200):
            at, mark = cls.places(keys, seed, segment, parts)
            size = (parts + 2) * segment
            count = np.bincount(at.ravel(), minlength=size)
            held = np.zeros(size, np.int64)
            index = np.arange(n)
            for row in at:
                np.bitwise_xor.at(held, row, index)
            order: list[tuple[np.ndarray, np.ndarray]] = []
            left = n
            single = np.flatnonzero(count == 1)
            while len(single):
                got, which = np.unique(held[single], return_index=True)
                order.append((got, single[which]))
                left -= len(got)
                cells = at[:, got]
                np.subtract.at(count, cells.ravel(), 1)
                for row in cells:
                    np.bitwise_xor.at(held, row, got)
                cells = np.unique(cells)
                single = cells[count[cells] == 1]
            if not left:
                table = np.zeros(size, np.uint8)
                for got, cell in reversed(order):
                    table[cell] = mark[got] ^ table[at[0, got]] ^ table[at[1, got]] ^ table[at[2, got]]
                return cls(seed, segment, parts, table)
            if seed % 10 == 0:
                parts += max(1, parts // 16)
        raise RuntimeError("no seed peels; are the keys distinct?")

    def admits(self, keys: np.ndarray) -> np.ndarray:
        at, mark = self.places(keys, self.seed, self.segment, self.parts)
        return (self.table[at[0]] ^ self.table[at[1]] ^ self.table[at[2]]) == mark


def keys_of(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(d)[:8] for d in digests), np.uint64)


def build_bucket(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    f = FuseFilter.build(keys_of(pdf["digest"]))
    return pd.DataFrame({"bucket": [key[0]], "seed": [f.seed], "segment": [f.segment], "parts": [f.parts], "cells": [f.table.tobytes()]})


def screen_bucket(batch: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    if batch.empty or filters.empty:
        return batch.assign(admitted=False)
    f = filters.iloc[0]
    held = FuseFilter(int(f["seed"]), int(f["segment"]), int(f["parts"]), np.frombuffer(f["cells"], np.uint8))
    return batch.assign(admitted=held.admits(keys_of(batch["digest"])))


def build_filters(snapshot: DataFrame) -> DataFrame:
    """``bucket, seed, segment, parts, cells`` from distinct ``bucket, digest``."""
    return snapshot.select("bucket", "digest").groupBy("bucket").applyInPandas(build_bucket, "bucket long, seed long, segment long, parts long, cells binary")


def digests(docs: DataFrame) -> DataFrame:
    return texts(docs).select("doc_id", F.unhex(F.sha2(normal(F.col("text")), 256)).alias("digest"))


def bucketed(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.conv(F.hex(F.substring("digest", 9, 4)), 16, 10).cast("long"), F.lit(buckets)))


def merge(snapshot: DataFrame, batch: DataFrame) -> DataFrame:
    """Groups ``digest, keep_id, group_size`` of both; each side has distinct ``digest, first_id, n``."""
    buckets = max(1, math.ceil(max(snapshot.count(), batch.count()) / BUCKET))
    old, new = bucketed(snapshot, buckets), bucketed(batch, buckets)
    filters = cut(build_filters(old), "filters")
    screened = new.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(screen_bucket, "digest binary, first_id long, n long, bucket long, admitted boolean")
    screened = cut(screened, "screened")
    exact = old.select("digest", F.col("first_id").alias("old_id"), F.col("n").alias("old_n"))
    met = cut(screened.where("admitted").join(exact, "digest").select("digest", F.least("first_id", "old_id").alias("keep_id"), (F.col("n") + F.col("old_n")).alias("group_size")), "met")
    alone = [x.select("digest", "first_id", "n").join(met.select("digest"), "digest", "left_anti").toDF("digest", "keep_id", "group_size") for x in (screened, snapshot)]
    return met.union(alone[0]).union(alone[1])


def differing(docs: DataFrame, members: DataFrame) -> DataFrame:
    """Ids of ``members`` (``doc_id, keep_id``) whose normalised bytes are not those of the row that stays."""
    ids = cut(members.select(F.explode(F.array("doc_id", "keep_id")).alias("doc_id")).distinct(), "copies")
    body = only(texts(docs), ids).select("doc_id", normal(F.col("text")).alias("t"))
    kept = body.select(F.col("doc_id").alias("keep_id"), F.col("t").alias("kt"))
    return members.where("doc_id <> keep_id").join(body, "doc_id").join(kept, "keep_id").where("t <> kt").select("doc_id").distinct()


def dedup(docs: DataFrame, in_snapshot: Column) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Rows for which ``in_snapshot`` holds are the snapshot, the others the batch.
    """
    every = cut(digests(docs), "digests")
    counted = every.groupBy("digest", F.coalesce(in_snapshot, F.lit(False)).alias("old")).agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
    counted = cut(counted, "counted")
    groups = cut(merge(*(counted.where(w).drop("old") for w in ("old", "not old"))), "groups")
    members = every.join(groups.where("group_size > 1"), "digest").select("doc_id", "keep_id")
    other = cut(differing(docs, members), "differing").withColumn("differs", F.lit(True))
    out = every.join(groups, "digest").join(F.broadcast(other) if other.count() < 1_000_000 else other, "doc_id", "left")
    keep = F.when(F.col("differs"), F.col("doc_id")).otherwise(F.col("keep_id"))
    size = F.when(F.col("differs"), F.lit(1).cast("long")).otherwise(F.col("group_size"))
    return out.select("doc_id", keep.alias("keep_id"), size.alias("group_size"), keep.eqNullSafe(F.col("doc_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
