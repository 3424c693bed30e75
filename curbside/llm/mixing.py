"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations only.

Every document gets the key -ln(u) / weight, u from a digest of its id: the smaller the key, the earlier its turn, and
heavier documents tend to come earlier. A source takes complete epochs of all its documents first; the rest of its
budget goes to documents in key order. No source is sorted as a whole: keys are counted in fine buckets, the bucket in
which the budget runs out is found from the buckets' sums, and only that bucket's rows are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbside.llm.common import WORD, text_or_empty
from curbside.session import settle

WEIGHTS = (5, 2, 1)  # of the sources in order, repeating
SHARE = 1.5  # of all words that the mix takes
LIMIT = 2.0  # times its own size that a source gives at most
BUCKETS = 1 << 16  # of the key range, per source
SEED = "mix"


def uniform(doc_id: Column) -> Column:
    """A number above 0 and below 1 from the digest of the id: 52 bits, the same at every run."""
    digest = F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) of `sizes(source, source_size)`, one row per source.

    Sharing by weight, stopping at the limit and sharing the excess anew ends where target = least(limit, t * weight)
    with one t for all. Sources in order of limit / weight reach their limits first, so t follows from running sums.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (place % len(WEIGHTS) + 1).cast("int"))
    ranked = sizes.withColumn("w", weight).withColumn("most", F.col("source_size") * LIMIT)
    order = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    # t if exactly the sources before this one are at their limits
    spent = F.coalesce(F.sum("most").over(before), F.lit(0.0))
    t = (SHARE * F.sum("source_size").over(every) - spent) / F.sum("w").over(after)
    with_t = ranked.withColumn("t", t).withColumn("nth", F.row_number().over(order))
    # the first source that stays below its limit has the right t; without one all are at their limits
    below = F.when(F.col("t") * F.col("w") <= F.col("most"), F.struct("nth", "t"))
    level = with_t.withColumn("level", F.min(below).over(every)["t"])
    return level.select(
        "source",
        "source_size",
        F.least(F.col("most"), F.coalesce(F.col("level") * F.col("w"), F.col("most"))).alias("target"),
    )


def quality_weights(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs` with a column `weight`: 2 for good labels, 0.5 for bad ones, 1 without a label."""
    known = labels.where("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("_q"))
    weight = F.when(F.col("_q") == 1, 2.0).when(F.col("_q") == 0, 0.5).otherwise(1.0)
    return docs.join(known, "doc_id", "left").withColumn("weight", weight).drop("_q")


def taken_words(measured: DataFrame) -> DataFrame:
    """`measured(doc_id, source, size, weight, ...)` with source_size, target, copies and taken.

    Rows of one id, size and source tie: those that come first in the bucket are taken first, and are alike anyway.
    """
    bucket = F.least(F.floor((1.0 - F.exp(-F.col("key"))) * BUCKETS), F.lit(BUCKETS - 1)).cast("int")
    keyed = settle(
        measured.withColumn("key", -F.log(uniform(F.col("doc_id"))) / F.col("weight")).withColumn("bucket", bucket), "mix"
    )
    sums = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    sizes = sums.groupBy("source").agg(F.sum("words").alias("source_size"))
    plan = (
        targets(sizes)
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    )
    run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bounds = (
        sums.withColumn("before", F.coalesce(F.sum("words").over(run), F.lit(0)))
        .join(plan.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
        .where("before <= rest")
        .groupBy("source", "source_size", "target", "epochs", "rest").agg(F.max(F.struct("bucket", "before")).alias("_b"))
        .select(
            F.col("source").alias("_s"), "source_size", "target", "epochs", "rest",
            F.col("_b.bucket").alias("last"), F.col("_b.before").alias("before"),
        )
    )
    placed = keyed.join(bounds, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    inner = Window.partitionBy("source").orderBy("key", "doc_id", "size")
    start = F.col("before") + F.sum("size").over(inner.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    # in the last bucket a document is taken if that brings the sum nearer to the budget; where whole epochs are all of it,
    # nothing is taken once more, empty documents neither
    edge = placed.where("bucket = last").withColumn(
        "once", (F.col("rest") > 0) & (start + F.col("size") / 2.0 <= F.col("rest"))
    )
    others = placed.where("bucket <> last").withColumn("once", (F.col("rest") > 0) & (F.col("bucket") < F.col("last")))
    return (
        others.unionByName(edge)
        .withColumn("copies", (F.col("epochs") + F.col("once").cast("long")).cast("int"))
        .withColumn("taken", (F.col("size") * F.col("copies")).cast("long"))
        .drop("key", "bucket", "last", "before", "rest", "once", "epochs")
    )


def mix(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken.

    Null texts have size 0 and take nothing; null sources are one source, last in order; null ids share one key;
    repeated rows are each taken by themselves; other columns are ignored.
    """
    measured = docs.select("doc_id", "source", F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"))
    return taken_words(quality_weights(measured, labels)).select("doc_id", "size", "source_size", "target", "taken")


def mixed(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The mix itself: each row of `docs` as often as it is taken, columns as they were, whatever their names.

    Null texts are empty: they take no words, and are written as often as whole epochs of their source. Null sources are
    one source; repeated rows are each taken by themselves; no documents give none.
    """
    names = [F.col(f"row.{c}").alias(c) for c in docs.columns]
    stored = settle(
        docs.select(
            F.struct(*docs.columns).alias("row"),
            F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"),
            F.monotonically_increasing_id().alias("at"),
        ),
        "mix-rows",
    )
    # numbers alone decide; texts are moved once, to those numbers
    measured = stored.select("row.doc_id", "row.source", "size", "at")
    decided = taken_words(quality_weights(measured, labels)).where("copies > 0").select("at", "copies")
    return stored.join(decided, "at").select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select(*names)
