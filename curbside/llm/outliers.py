"""Robust multivariate outliers among documents, in DataFrame operations only.

Four rates of a text, transformed to be roughly symmetric, are compared with a minimum-covariance-determinant estimate
of their language and source. The estimate follows from concentration steps: take the share of documents nearest by
Mahalanobis distance, compute their mean and covariance, repeat until the determinant falls no more. They start from the
lower quartiles, the medians and the upper quartiles of a group; the least determinant of the three is kept. A step is
one aggregate: rows are counted and summed per (group, start, bucket of distance), so that a group of any size shrinks
to some hundred rows before the shuffle, and the nearest share is a running sum over its buckets.
"""

from __future__ import annotations

from math import exp, factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbside.llm.common import SPACE, WORD, text_or_empty
from curbside.session import settle

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = r"[#*$%&|<>]"

# Base rule.
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

# The method: share of nearest documents, concentration steps, least scales of the four features (spread below these
# is of no interest, and keeps covariances regular where most documents have a rate of exactly zero), rows that a group
# needs for an estimate of its own, and the chi-square level beyond which a document is rejected. A group with several
# clusters has several local minima, hence several starts.
NEAREST = 0.75
STEPS = 20  # at most; a start is done when a step lowers its log determinant by less than FALL
FALL = 1e-3
LEAST_SCALE = (0.06, 0.05, 0.06, 0.10)
MIN_GROUP = 40
LEVEL = 0.99999

_P = len(LEAST_SCALE)
_FINE = 512  # buckets to a unit of a feature, for the start's quantiles
_LOG = 48  # buckets to a doubling of 1 + squared distance


# -- statistics ---------------------------------------------------------------------------------


def _repeated(hashes: str) -> list[tuple[str, Column]]:
    """Columns that lead from window hashes to the number of words in windows that occur more than once."""
    found = F.col(hashes)
    pairs = F.array_sort(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    some = F.size(F.array_distinct(found)) < F.size(found)
    placed = F.col("_pairs")
    twins = F.filter(
        placed,
        lambda x, k: F.coalesce(x["h"] == F.get(placed, k - 1)["h"], F.lit(False))
        | F.coalesce(x["h"] == F.get(placed, k + 1)["h"], F.lit(False)),
    )
    places = F.col("_places")
    # a window covers three words, fewer where the next repeated window starts before its end
    covered = F.aggregate(
        F.transform(places, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1), p + 3) - p)),
        F.lit(0),
        lambda total, n: total + n,
    )
    nothing = F.array().cast("array<struct<h:bigint,i:int>>")
    return [
        ("_pairs", F.when(some, pairs).otherwise(nothing)),
        ("_places", F.array_sort(F.transform(twins, lambda x: x["i"]))),
        ("n_repeat_words", F.when(F.size(places) > 0, covered).otherwise(F.lit(0)).cast("long")),
    ]


def with_statistics(docs: DataFrame) -> DataFrame:
    """`docs(text, ...)` with the five statistics (long) instead of the text; null texts have none of anything.

    Windows of three words are compared by 64-bit hashes; all work on one text stays in its row.
    """
    kept = [c for c in docs.columns if c != "text"]
    text = F.col("_text")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    words = F.col("_words")
    windows = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
    )
    df = docs.select(*kept, text_or_empty().alias("_text")).select(
        *kept,
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("_words"),
        F.char_length(F.regexp_replace(text, SPACE, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
    )
    df = df.select(
        *kept, "word_chars", "n_symbols", F.size("_words").cast("long").alias("n_words"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("_hashes"),
    )
    for name, column in _repeated("_hashes"):
        df = df.withColumn(name, column)
    return df.select(*kept, *STATS)


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * n)


# -- robust distances ---------------------------------------------------------------------------


def features() -> list[Column]:
    n, chars = F.col("n_words").cast("double"), F.col("word_chars").cast("double")
    return [
        F.log(chars / n),
        F.sqrt(F.col("n_symbols") / chars),
        F.sqrt(F.col("n_dup_lines") / n),
        F.sqrt(F.col("n_repeat_words") / n),
    ]


def chi_square_quantile(level: float, degrees: int) -> float:
    """For an even number of degrees, by bisection."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi_square(mid, degrees) < level else (low, mid)
    return low


def _chi_square(x: float, degrees: int) -> float:
    return 1.0 - exp(-x / 2) * sum((x / 2) ** k / factorial(k) for k in range(degrees // 2))


def _consistency(share: float) -> float:
    """What turns the covariance of the nearest share of a normal sample into that of the whole."""
    return share / _chi_square(chi_square_quantile(share, _P), _P + 2)


def _groups(rows: DataFrame) -> DataFrame:
    """`rows` with group `g`: language and source; small ones are pooled by language, then altogether.

    Pools that are still too small have a null group and get no verdict.
    """
    pair = F.struct(F.col("lang").alias("lang"), F.col("source").alias("source"), F.lit(2).alias("level"))
    lang = F.struct(F.col("lang").alias("lang"), F.lit(None).cast("string").alias("source"), F.lit(1).alias("level"))
    every = F.struct(F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source"), F.lit(0).alias("level"))
    counts = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    counts = counts.withColumn("g", F.when(F.col("n") >= MIN_GROUP, pair).otherwise(lang))
    for wider in (every, F.lit(None).cast(counts.schema["g"].dataType)):
        total = F.sum("n").over(Window.partitionBy("g"))
        counts = counts.withColumn("m", total).withColumn("g", F.when(F.col("m") >= MIN_GROUP, F.col("g")).otherwise(wider))
    key = F.when(F.col("g").isNotNull(), F.to_json("g", {"ignoreNullFields": "false"}))
    named = counts.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), key.alias("g"))
    return rows.join(named, F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s"))).drop("_l", "_s")


def _start(rows: DataFrame) -> DataFrame:
    """Per group and start: a quartile of every feature as centre, quartile ranges as scales, from counts in fine
    buckets."""
    cells = rows.select("g", F.posexplode(F.array(*[F.col(f"x{i}") for i in range(_P)])).alias("i", "x"))
    counts = cells.groupBy("g", "i", F.floor(F.col("x") * _FINE).alias("b")).count()
    by = Window.partitionBy("g", "i")
    run = F.sum("count").over(by.orderBy("b").rowsBetween(Window.unboundedPreceding, 0)) / F.sum("count").over(by)
    found = counts.withColumn("run", run).groupBy("g", "i").agg(
        *[F.min(F.when(F.col("run") >= q, F.col("b"))).alias(n) for n, q in (("q1", 0.25), ("q2", 0.5), ("q3", 0.75))]
    )
    spread = (F.col("q3") - F.col("q1")) / (_FINE * 1.349)
    starts = F.array(*[F.struct(F.lit(k).alias("start"), ((F.col(q) + 0.5) / _FINE).alias("c")) for k, q in enumerate(("q2", "q1", "q3"))])
    one = found.select("g", "i", F.inline(starts), (spread * spread).alias("v"))
    return one.groupBy("g", "start").agg(
        *[F.max(F.when(F.col("i") == i, F.col("c"))).alias(f"m{i}") for i in range(_P)],
        *[F.max(F.when(F.col("i") == i, F.col("v") if i == j else F.lit(0.0))).alias(f"s{i}{j}") for i in range(_P) for j in range(i + 1)],
    )


def _whitening(estimate: DataFrame, scale: float) -> DataFrame:
    """(g, start, m, w, log_det): centre, inverse Cholesky factor and log determinant of `scale` times the covariance, least
    scales on its diagonal.

    One row per group and start; it is written, so that steps do not nest their arithmetic.
    """
    for i in range(_P):
        for j in range(i + 1):
            value = F.col(f"s{i}{j}") * scale + (LEAST_SCALE[i] ** 2 if i == j else 0.0)
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            estimate = estimate.withColumn(f"l{i}{j}", F.sqrt(value) if i == j else value / F.col(f"l{j}{j}"))
    for j in range(_P):
        for i in range(j, _P):
            value = F.lit(1.0) if i == j else -sum((F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)), F.lit(0.0))
            estimate = estimate.withColumn(f"w{i}{j}", value / F.col(f"l{i}{i}"))
    names = [f"m{i}" for i in range(_P)] + [f"w{i}{j}" for i in range(_P) for j in range(i + 1)]
    log_det = sum((2 * F.log(F.col(f"l{i}{i}")) for i in range(_P)), F.lit(0.0))
    return settle(estimate.select("g", "start", *names, log_det.alias("log_det")), "ellipsoids")


def _distances(rows: DataFrame, whitening: DataFrame) -> DataFrame:
    """`rows` with the squared Mahalanobis distance d2, once per start of their group; null where the group has no
    estimate."""
    joined = rows.join(whitening.withColumnRenamed("g", "_g"), F.col("g") == F.col("_g"), "left")
    away = [F.col(f"x{i}") - F.col(f"m{i}") for i in range(_P)]
    white = [sum((F.col(f"w{i}{j}") * away[j] for j in range(i + 1)), F.lit(0.0)) for i in range(_P)]
    return joined.select(*rows.columns, "start", sum((y * y for y in white), F.lit(0.0)).alias("d2"))


def _concentrated(rows: DataFrame, whitening: DataFrame, share: float | None) -> DataFrame:
    """Mean and covariance of the nearest `share` of each group, or of all within the 97.5 % ellipsoid."""
    distances = _distances(rows.where("g is not null"), whitening)
    bucket = F.floor(F.log2(1.0 + F.col("d2")) * _LOG)
    sums = [F.count("*").alias("n")]
    sums += [F.sum(f"x{i}").alias(f"a{i}") for i in range(_P)]
    sums += [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"b{i}{j}") for i in range(_P) for j in range(i + 1)]
    if share is None:
        distances = distances.where(F.col("d2") <= chi_square_quantile(0.975, _P))
    cells = distances.groupBy("g", "start", bucket.alias("b")).agg(*sums)
    if share is not None:
        by = Window.partitionBy("g", "start")
        before = F.sum("n").over(by.orderBy("b").rowsBetween(Window.unboundedPreceding, -1))
        cells = cells.withColumn("_before", F.coalesce(before, F.lit(0))).withColumn("_all", F.sum("n").over(by))
        cells = cells.where(F.col("_before") < F.col("_all") * share)
    names = [c for c in cells.columns if c[0] in "nab" and c != "b"]
    total = cells.groupBy("g", "start").agg(*[F.sum(c).alias(c) for c in names])
    mean = [(F.col(f"a{i}") / F.col("n")).alias(f"m{i}") for i in range(_P)]
    covariance = [
        (F.col(f"b{i}{j}") / F.col("n") - F.col(f"a{i}") / F.col("n") * F.col(f"a{j}") / F.col("n")).alias(f"s{i}{j}")
        for i in range(_P) for j in range(i + 1)
    ]
    return total.select("g", "start", *mean, *covariance)


def least_determinants(rows: DataFrame) -> DataFrame:
    """(g, start, m, w, log_det) of the start of each group that comes to the least determinant."""
    whitening, last = _whitening(_start(rows.where("g is not null")), 1.0), None
    for _ in range(STEPS):
        whitening = _whitening(_concentrated(rows, whitening, NEAREST), _consistency(NEAREST))
        if last is not None:
            old = last.select(F.col("g"), F.col("start"), F.col("log_det").alias("old"))
            fallen = whitening.join(old, ["g", "start"]).agg(F.max(F.col("old") - F.col("log_det"))).first()[0]
            if fallen is None or fallen < FALL:
                break
        last = whitening
    best = whitening.groupBy("g").agg(F.min_by("start", F.struct("log_det", "start")).alias("start"))
    return settle(whitening.join(best, ["g", "start"]), "ellipsoids")


def robust_distances(rows: DataFrame) -> DataFrame:
    """`rows(g, x0, x1, ...)` with d2 under the reweighted estimate of their group."""
    estimate = _concentrated(rows, least_determinants(rows), None)
    return _distances(rows, _whitening(estimate, _consistency(0.975))).drop("start")


def judged(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the five statistics, base_failed, kept, d2.

    Null texts count as empty: no words, so they fail the base rule. Null languages and sources are groups of their
    own. Documents that fail the base rule take no part in the estimates and have a null d2, as have those whose pool
    is too small for an estimate; these are kept. Repeated rows stay; other columns are ignored.
    """
    stats = settle(with_statistics(docs.select("doc_id", "lang", "source", "text")), "statistics")
    passed = stats.where(~base_failed()).withColumns({f"x{i}": x for i, x in enumerate(features())})
    rows = settle(_groups(passed), "grouped")
    cutoff = chi_square_quantile(LEVEL, _P)
    good = robust_distances(rows).select(
        "doc_id", *STATS, F.lit(False).alias("base_failed"),
        F.coalesce(F.col("d2") <= cutoff, F.lit(True)).alias("kept"), "d2",
    )
    bad = stats.where(base_failed()).select(
        "doc_id", *STATS, F.lit(True).alias("base_failed"), F.lit(False).alias("kept"), F.lit(None).cast("double").alias("d2")
    )
    return good.unionByName(bad)
