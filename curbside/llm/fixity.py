"""WARC fixity audit by Merkle trees.

Pages become WARC records; records in order of their slot make up archives, and each has an offset and a length there.
Every archive has a hash tree: a leaf is the digest of a record with its slot and length, a node the digest of its
children with the byte range they cover, counted from the node's start, so that a change of length upsets its own path
only. Two replicas are compared from the roots down: a level joins only the children of nodes that differ, so intact
archives cost one comparison, and the trees rather than the records are shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbside.session import settle

FAN_OUT = 16
LEVELS = 3  # of nodes above the leaves
ARCHIVE_SLOTS = FAN_OUT**LEVELS


def record(url: Column, body: Column) -> Column:
    """A WARC resource record as binary; null parts count as empty."""
    payload = F.coalesce(body.cast("binary"), F.lit("").cast("binary"))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: "), F.coalesce(url.cast("string"), F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(head.cast("binary"), payload, F.lit("\r\n\r\n").cast("binary"))


def leaves(records: DataFrame) -> DataFrame:
    """(archive, slot, length, digest) of `records(key, record)`. The key, a number, fixes archive and slot.

    Null keys are left out. Records of one key are one leaf: their digests in order, their lengths added.
    """
    one = records.where("key is not null").select(
        F.floor(F.col("key") / ARCHIVE_SLOTS).cast("long").alias("archive"),
        F.pmod(F.col("key"), F.lit(ARCHIVE_SLOTS)).cast("int").alias("slot"),
        F.octet_length("record").cast("long").alias("length"),
        F.sha2("record", 256).alias("d"),
    )
    # copies are counted before they meet, so a key with very many is still a short list
    counted = one.groupBy("archive", "slot", "length", "d").agg(F.count("*").alias("n"))
    parts = F.array_sort(F.collect_list(F.concat_ws(":", "d", "n")))
    return counted.groupBy("archive", "slot").agg(
        F.sum(F.col("length") * F.col("n")).alias("length"), parts.alias("parts")
    ).select("archive", "slot", "length", F.sha2(F.concat_ws(",", "parts"), 256).alias("digest"))


def tree(level_zero: DataFrame) -> DataFrame:
    """(level, archive, place, start, length, digest) of all nodes above stored leaves and of these; 0 is the leaves.

    `start` is the node's first byte counted from its parent's. A node has FAN_OUT children at most, so the lists that
    are put in order are short.
    """
    nodes = level_zero.select("archive", F.col("slot").alias("place"), "length", "digest")
    done = []
    for level in range(LEVELS + 1):
        if level == LEVELS:
            done.append(nodes.select(F.lit(level).alias("level"), "archive", "place", F.lit(0).cast("long").alias("start"), "length", "digest"))
            break
        children = F.array_sort(F.collect_list(F.struct("place", "length", "digest")))
        parents = nodes.groupBy("archive", F.floor(F.col("place") / FAN_OUT).cast("int").alias("up")).agg(children.alias("c"))
        c = F.col("c")
        before = F.transform(
            c, lambda x, i: F.aggregate(F.slice(c, 1, i), F.lit(0).cast("long"), lambda total, y: total + y["length"])
        )
        ranged = F.transform(
            F.arrays_zip(c.alias("node"), before.alias("start")),
            lambda x: F.struct(x["node"]["place"].alias("place"), x["start"].alias("start"), x["node"]["length"].alias("length"), x["node"]["digest"].alias("digest")),
        )
        parents = settle(parents.select("archive", "up", ranged.alias("c")), "nodes")
        done.append(
            parents.select("archive", F.explode("c").alias("n")).select(F.lit(level).alias("level"), "archive", "n.*")
        )
        text = F.concat_ws(",", F.transform("c", lambda x: F.concat_ws(":", x["place"], x["start"], x["length"], x["digest"])))
        length = F.aggregate("c", F.lit(0).cast("long"), lambda total, x: total + x["length"])
        nodes = parents.select("archive", F.col("up").alias("place"), length.alias("length"), F.sha2(text, 256).alias("digest"))
    return reduce(DataFrame.unionByName, done)


def mismatches(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """Leaves of two stored trees that differ, found from the roots down.

    (archive, slot, fault, start, length, replica_length, ...): the fault is `missing` or `extra` in the replica,
    `changed` at equal length, or `resized`.
    """
    found = None
    for level in range(LEVELS, -1, -1):
        a, b = (t.where(F.col("level") == level).drop("level") for t in (primary, replica))
        if found is not None:
            # only children of nodes that differ
            up = found.select("archive", F.col("place").alias("up"))
            a, b = (
                t.withColumn("up", F.floor(F.col("place") / FAN_OUT).cast("int")).join(up, ["archive", "up"], "left_semi").drop("up")
                for t in (a, b)
            )
        b = b.select("archive", "place", F.col("start").alias("replica_start"), F.col("length").alias("replica_length"), F.col("digest").alias("replica_digest"))
        both = a.join(b, ["archive", "place"], "full_outer")
        found = settle(both.where(~F.col("digest").eqNullSafe(F.col("replica_digest"))), "mismatches")
    fault = (
        F.when(F.col("replica_digest").isNull(), "missing").when(F.col("digest").isNull(), "extra")
        .when(F.col("length") == F.col("replica_length"), "changed").otherwise("resized")
    )
    return found.select("archive", F.col("place").alias("slot"), fault.alias("fault"), "start", "length", "replica_length")


def offsets(level_zero: DataFrame) -> DataFrame:
    """Leaves with their byte offset in the archive. An archive has ARCHIVE_SLOTS records at most, whatever its bytes."""
    before = Window.partitionBy("archive").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")
    return level_zero.select("archive", "slot", offset.alias("byte_offset"))


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """Records of `replica(key, record)` that differ from `primary(key, record)`, one row per key.

    archive, slot, key, fault, byte_offset and length in the primary (null if extra), replica_length (null if missing). Two
    empty replicas, or equal ones, give no rows. Null keys cannot be placed and are left out; repeated rows count as
    part of their key's record, so one more copy is a fault; null records count as empty.
    """
    sides = [
        settle(leaves(side.select("key", F.coalesce("record", F.lit("").cast("binary")).alias("record"))), "leaves")
        for side in (primary, replica)
    ]
    trees = [settle(tree(side), "tree") for side in sides]
    found = mismatches(*trees)
    places = offsets(sides[0].join(found.select("archive").distinct(), "archive", "left_semi"))
    return found.join(places, ["archive", "slot"], "left").select(
        "archive", "slot", (F.col("archive") * ARCHIVE_SLOTS + F.col("slot")).alias("key"), "fault", "byte_offset", "length", "replica_length"
    )


# -- a replica with known faults ----------------------------------------------------------------


def damaged(records: DataFrame) -> DataFrame:
    """`records(key, record)` as a storage fault would leave them, by the key: some bytes changed, some cut, some lost,
    and some records that only the replica has."""
    key, raw = F.col("key"), F.col("record")
    n = F.octet_length(raw)
    flipped = F.concat(F.substring(raw, 1, n - 1), F.lit("?").cast("binary"))
    cut = F.substring(raw, 1, n - 3)
    bad = F.when(key % 97 == 5, flipped).when(key % 89 == 7, cut).otherwise(raw)
    lost = F.coalesce(key % 101 == 11, F.lit(False))
    extra = records.where(key % 103 == 13).select((-key - 1).alias("key"), "record")
    return records.where(~lost).select("key", bad.alias("record")).unionByName(extra)
