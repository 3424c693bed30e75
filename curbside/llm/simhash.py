"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most `radius` bits apart share a point that lies within radius / 2 of both. So every distinct
fingerprint emits all variants within that distance, the variants are shuffled, and fingerprints that meet are linked.
Bounds by construction: copies are one fingerprint before anything is emitted, and a bucket holds at most the ball
around its variant (65 fingerprints for radius 2), however many documents are alike. By the triangle inequality all
members of a bucket are within `radius` of each other, so a star from the least member loses no link; every pair is
verified all the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbside.llm.common import tokens_of
from curbside.llm.components import connected_components
from curbside.session import settle

SEED = 42


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of every word shingle, repeats included; of the whole sequence if it is shorter; none without words."""
    found = tokens_of(text)
    if not found:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(found)
    if len(found) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    starts = [0, *accumulate(len(w) + 1 for w in found)]
    digest = xxhash.xxh64_intdigest
    cuts = zip(starts, starts[words:])
    return np.array([digest(joined[a : b - 1], SEED) for a, b in cuts], dtype=np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half the hashes, as a signed 64-bit number; zero for no hashes."""
    n = len(hashes)
    if not n:
        return 0
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8)).reshape(-1, 64)
    # eight one-byte counters to a machine word, for as many rows as a byte can count
    lanes = np.add.reduceat(bits.view(np.uint64), np.arange(0, n, 255), axis=0)
    counts = lanes.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big", signed=True)


def fingerprint(text: Column, words: int = 3) -> Column:
    """Column of SimHash fingerprints (long) of a text column; null and empty texts give zero."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([majority(shingle_hashes(t, words)) for t in batch], dtype="int64")

    return of(text)


def ball(half: int) -> list[int]:
    """Masks of all changes of at most `half` bits, as signed 64-bit numbers."""
    masks = [sum(1 << i for i in bits) for k in range(half + 1) for bits in combinations(range(64), k)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def fingerprint_links(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """Links (a, b) that connect all fingerprints of `distinct(fp)` at most `radius` bits apart, some of them by way
    of others. `radius` is even."""
    if radius < 0 or radius % 2:
        raise ValueError("the radius must be even")
    # few bytes, but each row becomes 65: dealt out by number, so that adaptive execution does not pack them into one task.
    # By a hash of the fingerprint, as rows that are partitioned by the fingerprint already would not be dealt again.
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    variants = distinct.repartition(parts, F.xxhash64("fp")).select(
        "fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(m)) for m in ball(radius // 2)])).alias("variant")
    )
    buckets = variants.groupBy("variant").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    star = buckets.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b").distinct()
    return star.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def fingerprint_components(stored: DataFrame, radius: int = 2) -> DataFrame:
    """(fp, component) of every distinct fingerprint of `stored(fp, ...)`; the component is a fingerprint."""
    distinct = stored.select("fp").distinct()
    found = connected_components(fingerprint_links(distinct, radius)).withColumnRenamed("node", "fp")
    return distinct.join(found, "fp", "left").select("fp", F.coalesce("component", "fp").alias("component"))


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (least doc_id it reaches by links).

    Null and empty texts have the fingerprint zero and are linked like any other; null ids count as greater than all
    others, so a component of null ids only has a null component_id; repeated rows stay; other columns are ignored.
    """
    stored = settle(docs.select("doc_id", fingerprint(F.col("text"), words).alias("fp")), "fingerprints")
    component = fingerprint_components(stored, radius)
    least = (
        stored.groupBy("fp").agg(F.min("doc_id").alias("_d")).join(component, "fp")
        .groupBy("component").agg(F.min("_d").alias("component_id"))
    )
    named = settle(component.join(least, "component").select("fp", "component_id"), "components")
    return stored.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """`docs` with one document of each component: the least doc_id, any one of repeated rows, null ids last."""
    names = [F.col(f"row.{c}").alias(c) for c in docs.columns]
    stored = settle(
        docs.select(
            F.struct(*docs.columns).alias("row"),
            fingerprint(F.col("text"), words).alias("fp"),
            F.monotonically_increasing_id().alias("at"),
        ),
        "fingerprints",
    )
    order = F.struct(F.col("row.doc_id").isNull(), F.col("row.doc_id"), F.col("at"))
    kept = (
        stored.groupBy("fp").agg(F.min(order).alias("o")).join(fingerprint_components(stored, radius), "fp")
        .groupBy("component").agg(F.min("o").alias("o")).select(F.col("o.at").alias("at"))
    )
    return stored.join(kept, "at", "left_semi").select(*names)
