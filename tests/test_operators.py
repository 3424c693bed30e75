from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from curbside.operators.clean import clean, clean_counts, exclude_codes, in_range
from curbside.operators import features
from curbside.operators.dedup import keep_first, mark_duplicates
from curbside.operators.joins import (
    attach_zones,
    broadcast_if_small,
    county_hour_means,
    is_broadcastable,
    map_region_codes,
)
from curbside.operators.key_filter import MOST_KEYS, MOST_WORDS, KeyFilter
from curbside.operators.merge import merge_stats, merged, new_rows
from curbside.operators.ordered import last_n, latest_per_key, previous_value
from curbside.operators.profile import group_profile
from curbside.plans.experiments import plan_text
from curbside.sources.layout import storage_footprint, storage_overhead, write_partitioned
from tests.conftest import at, rows


def hot_rows(n: int, seed: int = 1) -> list[tuple]:
    """Rows of which a third share one key, with verbatim copies and NULL keys."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = 7 if i % 3 == 0 else rng.choice([None, *range(40)])
        out.append((key, rng.randrange(5), rng.choice("xyz")))
    return out


def test_range_passes_null_and_refuses_no_bounds(spark):
    df = spark.createDataFrame([(None,), (1.0,), (2.0,), (3.0,), (float("nan"),)], "v double")
    assert df.where(in_range("v", 2, None)).count() == 4  # NaN is above all numbers
    assert df.where(in_range("v", None, 2)).count() == 3
    with pytest.raises(ValueError):
        in_range("v", None, None)


def test_exclude_codes_drops_null(spark):
    df = spark.createDataFrame([(1, 2), (264, 2), (1, 265), (None, 1)], "a int, b int")
    assert rows(exclude_codes(df, ("a", "b"), (264, 265))) == [(1, 2)]


def test_keep_first_takes_the_smallest_row_and_cuts_before_the_shuffle(spark):
    data = hot_rows(900)
    df = spark.createDataFrame(data, "k int, a int, b string").repartition(5)
    best = {}
    for k, a, b in data:
        best[k] = min(best.get(k, (a, b)), (a, b))
    got = keep_first(df, ["k"])
    assert {r.k: (r.a, r.b) for r in got.collect()} == best
    plan = plan_text(got)
    assert plan.count("WindowGroupLimit") >= 2  # one before, one after the exchange


def test_mark_duplicates_against_brute_force(spark):
    data = hot_rows(1200)
    df = spark.createDataFrame(data, "k int, a int, b string").repartition(6)
    marked = mark_duplicates(df, ["k"]).collect()
    assert Counter((r.k, r.a, r.b) for r in marked) == Counter(data)
    kept = {r.k: (r.a, r.b) for r in marked if not r._duplicate}
    assert sum(not r._duplicate for r in marked) == len(kept) == len({d[0] for d in data})
    assert all(kept[k] == min((a, b) for kk, a, b in data if kk == k) for k in kept)


def test_mark_duplicates_leaves_others_out(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 3)], "k int, a int")
    marked = mark_duplicates(df, ["k"], among=F.col("a") > 1)
    assert {r.a: r._duplicate for r in marked.collect()} == {1: False, 2: False, 3: True}


def test_clean_and_its_counts(spark):
    data = [(1, 5.0), (1, 5.0), (None, 5.0), (2, -1.0), (3, None), (4, 99.0)]
    df = spark.createDataFrame(data, "k int, v double")
    assert rows(clean(df, ["k"], {"v": (0, 50)})) == rows(spark.createDataFrame([(1, 5.0), (3, None)], df.schema))
    assert rows(clean_counts(df, ["k"], {"v": (0, 50)})) == [(6, 2, 4)]


def test_zones_for_both_roles_keep_unmatched_trips(spark):
    trips = spark.createDataFrame([(1, 2), (2, 9), (None, 1)], "pu_location_id int, do_location_id int")
    zones = spark.createDataFrame([(1, "A", "X"), (2, "B", "Y")], "location_id int, zone string, borough string")
    out = attach_zones(trips, zones)
    assert rows(out.select("pickup_zone", "pickup_borough", "dropoff_zone", "dropoff_borough")) == sorted(
        [("A", "X", "B", "Y"), ("B", "Y", None, None), (None, None, "A", "X")], key=lambda r: (r[0] is not None, str(r[0]))
    )
    assert "CartesianProduct" not in plan_text(out)


def test_large_sides_are_not_broadcast_and_give_the_same(spark):
    big = spark.range(1000)
    assert is_broadcastable(big) and not is_broadcastable(big, max_rows=999) and not is_broadcastable(big, max_bytes=99)
    facts = spark.createDataFrame([(7 if i % 3 == 0 else i,) for i in range(300)], "id bigint")
    small = facts.join(broadcast_if_small(big), "id", "left")
    large = facts.join(broadcast_if_small(big, max_rows=1), "id", "left")
    assert rows(small) == rows(large)


def test_region_codes_and_county_means(spark):
    df = spark.createDataFrame([("Bronx",), ("EWR",), ("Nowhere",), (None,)], "pickup_borough string")
    codes = {r.pickup_borough: (r.state_code, r.county_code) for r in map_region_codes(df).collect()}
    assert codes == {"Bronx": ("36", "005"), "EWR": ("34", "013"), "Nowhere": (None, None), None: (None, None)}
    air = spark.createDataFrame(
        [("36", "005", 1, 2.0), ("36", "5", 1, 4.0), ("1", "1", 1, 9.0)],
        "state_code string, county_code string, time_utc int, sample_measurement double",
    )
    assert rows(county_hour_means(air, [("x", "36", "005")])) == [(36, 5, 1, 3.0)]
    assert county_hour_means(air).count() == 2


def test_profile_against_brute_force(spark):
    rng = random.Random(3)
    data = [("hot" if i % 3 == 0 else rng.choice(["a", "b", None]), rng.choice([1, 2, 3, None]),
             rng.choice("pq"), rng.choice([1.0, 2.0, None]), rng.randrange(9)) for i in range(600)]
    df = spark.createDataFrame(data, "g string, m int, s string, v double, d int")
    got = group_profile(df, "g", {"mode_m": F.col("m"), "mode_s": F.col("s")}, {"mean_v": F.col("v")},
                        {"days": F.col("d")}).collect()
    by = defaultdict(list)
    for row in data:
        by[row[0]].append(row)

    def mode(values):
        counts = Counter(v for v in values if v is not None)
        return min(counts, key=lambda v: (-counts[v], v))

    assert len(got) == len(by)
    for r in got:
        group = by[r.g]
        known = [x[3] for x in group if x[3] is not None]
        assert (r.trips, r.mode_m, r.mode_s, r.days) == (
            len(group), mode(x[1] for x in group), mode(x[2] for x in group), len({x[4] for x in group})
        )
        assert r.mean_v == pytest.approx(sum(known) / len(known))


def test_profile_of_a_group_without_values(spark):
    df = spark.createDataFrame([("a", None, None)], "g string, m int, v double")
    row = group_profile(df, "g", {"mode_m": F.col("m")}, {"mean_v": F.col("v")}).first()
    assert (row.trips, row.mode_m, row.mean_v) == (1, None, None)


def test_previous_value_equals_lag_for_a_hot_group(spark):
    rng = random.Random(5)
    data = [("hot" if i % 3 else rng.choice(["a", "b", None]), rng.randrange(50), i, rng.choice([None, 1.0, 2.5]))
            for i in range(800)]
    df = spark.createDataFrame(data, "g string, t int, id int, v double")
    found = previous_value(df, "g", ["t", "id"], "v", "before")
    got, last = {r.id: r.before for r in found.collect()}, {}
    for g, t, i, v in sorted(data, key=lambda r: (str(r[0]), r[1], r[2])):
        assert got[i] == last.get(g)
        last[g] = v


def test_latest_and_last_n(spark):
    df = spark.createDataFrame([(1, 5), (1, 9), (2, 3), (None, 1)], "k int, t int")
    assert rows(latest_per_key(df, ["k"], [F.col("t").desc()])) == [(None, 1), (1, 9), (2, 3)]
    limited = last_n(df, 2, [F.col("t").desc()])
    assert [r.t for r in limited.collect()] == [9, 5]
    assert "TakeOrderedAndProject" in plan_text(limited)


def test_merge_is_null_safe_idempotent_and_evolves(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (None, "n", 2.0)], "k int, s string, v double")
    update = spark.createDataFrame(
        [(1, "a", 9.0, 0), (None, "n", 9.0, 0), (None, "m", 3.0, 1), (2, "a", 4.0, 1)],
        "k int, s string, v double, extra int",
    )
    for prune in (True, False):
        assert rows(new_rows(update, target, ["k", "s"], prune).select("k", "s")) == [(None, "m"), (2, "a")]
    after = merged(target, update, ["k", "s"])
    assert after.columns == ["k", "s", "v", "extra"] and after.count() == 4
    assert merged(after, update, ["k", "s"]).count() == 4
    stats = merge_stats(target, update, ["k", "s"]).first()
    assert (stats.rows_before, stats.update_rows_considered, stats.inserted, stats.rows_after,
            stats.duplicates_ignored_vs_target) == (2, 4, 2, 4, 2)


def test_merge_plan_filters_target_keys_before_their_shuffle(spark):
    target = spark.range(1000).withColumn("t", F.col("id") % 10)
    with_broadcast_off = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    for k, v in with_broadcast_off.items():
        spark.conf.set(k, v)
    try:
        plan = plan_text(new_rows(target, target, ["id", "t"], prune=False))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    tree = plan.split("\n\n")[0]
    # the updates, their filter (summed, then sent to all), and those target keys that passed it
    assert tree.count("Exchange") == 4 and tree.count("BroadcastExchange") == 1
    shuffled = tree[tree.rindex("HashAggregate", 0, tree.index("BroadcastHashJoin")) :]
    assert "BroadcastHashJoin Inner" in shuffled and "getbit" in plan


def test_pruned_merge_reads_less(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 1000).withColumn("at", F.lit(at("2024-01-01 00:00"))).write.parquet(path)
    update = spark.createDataFrame([(990,), (2000,)], "id bigint")
    plan = plan_text(new_rows(update, spark.read.parquet(path), ["id"]))
    assert "GreaterThanOrEqual(id,990)" in plan and "ReadSchema: struct<id:bigint>" in plan


def test_partitioned_write_prunes_and_measures(spark, tmp_path):
    path = str(tmp_path / "by_day")
    df = spark.range(300).withColumn("pickup_date", F.when(F.col("id") % 3 > 0, "2024-01-01").otherwise("2024-02-01"))
    write_partitioned(df, path, ["pickup_date"])
    stored = spark.read.parquet(path)
    assert dict(stored.dtypes)["pickup_date"] == "string"
    pruned = stored.where("pickup_date >= '2024-01-01' AND pickup_date < '2024-01-02'")
    assert pruned.count() == 200
    filters = [line for line in plan_text(pruned).splitlines() if "PartitionFilters" in line]
    assert filters and "pickup_date" in filters[0]
    size = storage_footprint(spark, path).first()
    assert size.files >= 2 and size.bytes > 0 and size.rows == 300
    whole = storage_footprint(spark, path)
    assert storage_overhead(whole, whole).first().overhead_percent == 100.0


def test_duplicates_of_a_hot_key_after_a_join_on_it(spark):
    """Half of all rows have one key and lie in one partition: the first round still has many groups."""
    lines = spark.range(2000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    names = spark.range(2000).select(F.col("id").alias("k"), F.lit("n").alias("name"))
    joined = lines.join(names.hint("shuffle_hash"), "k")
    marked = mark_duplicates(joined, ["k"])
    found = rows(marked.where("NOT _duplicate").groupBy("k").agg(F.min("id").alias("id"), F.count("*").alias("n")))
    assert [r for r in found if r[0] == 7] == [(7, 0, 1)] and all(n == 1 for _, _, n in found)
    assert marked.count() == joined.count()
    window = [line for line in plan_text(marked).splitlines() if "Arguments" in line and "_salt" in line]
    assert window


def test_air_update_skips_unreadable_dates(spark):
    from curbside.operators.generate import air_update

    raw = spark.createDataFrame(
        [(36, 61, 1, 1, "2024-01-05", "10:00", "2024-01-05", "15:00", 8.0),
         (36, 61, 1, 1, "2024-01-06", "10:00", None, "15:00", 9.0),
         (36, 61, 2, 1, "not a day", "10:00", "2024-01-05", "99:00", 9.0)],
        "state_code int, county_code int, site_num int, poc int, date_local string, time_local string, "
        "date_gmt string, time_gmt string, sample_measurement double",
    )
    new = air_update(raw, hours=2)
    assert rows(new.select("site_num", "date_gmt", "time_gmt")) == [(1, "2024-01-05", "16:00"), (1, "2024-01-05", "17:00")]


def test_key_filter_lets_all_its_keys_and_few_others_pass(spark):
    """50 million keys, far more than a fixed table of 2^24 bits could tell apart."""
    keys = spark.range(0, 100_000_000, 2).select(F.struct("id").alias("_key"))
    key_filter = KeyFilter(keys, 50_000_000)
    assert key_filter.words == MOST_WORDS and not key_filter.open
    asked = spark.range(40_000_000, 40_400_000).select("id", F.struct("id").alias("_key"))
    passed_ = key_filter.cut(asked, F.col("_key")).select((F.col("id") % 2).alias("odd")).groupBy("odd").count().collect()
    counts = {r.odd: r["count"] for r in passed_}
    assert counts[0] == 200_000 and counts.get(1, 0) < 12_000


def test_key_filter_edges(spark):
    rows_ = spark.createDataFrame([(1, None), (None, "a"), (None, None), (2, "b")], "a int, b string")
    keyed = rows_.where("a IS NULL").select(F.struct("a", "b").alias("_key"))
    tagged = KeyFilter(keyed, 2).tag(rows_, F.struct("a", "b"), "maybe")
    assert tagged.where("a IS NULL AND NOT maybe").isEmpty() and tagged.count() == 4
    assert KeyFilter(keyed, MOST_KEYS + 1).cut(rows_, F.struct("a", "b")).count() == 4
    assert KeyFilter(keyed.limit(0), 0).cut(rows_, F.struct("a", "b")).count() == 0


def test_rows_of_single_keys_are_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(3000).selectExpr("id", "if(id < 60, id div 3, id) AS k", "repeat('x', 50) AS wide").write.parquet(path)
    df = spark.read.parquet(path)
    marked = mark_duplicates(df, ["k"])
    assert marked.where("_duplicate").count() == 40 and marked.count() == 3000
    plan = plan_text(marked)
    assert "Union" in plan and "BroadcastHashJoin" in plan
    # rows that reach the ranking: those of repeated keys, and few others
    suspects = marked.where("_duplicate").select("k").distinct().count()
    assert suspects == 20
    assert mark_duplicates(df.where("id >= 60"), ["k"]).where("_duplicate").isEmpty()


def test_category_index_equals_the_fitted_one(spark):
    values = ["b"] * 5 + ["a"] * 5 + ["c"] * 9 + [None] * 3 + ["d"]
    df = spark.createDataFrame([(v, i % 3) for i, v in enumerate(values)], "name string, number int").repartition(4)
    ours = features.category_index(df, ("name", "number"))
    theirs = features.indexer(("name", "number")).fit(df).transform(df)
    assert sorted(map(str, ours.select(*theirs.columns).collect())) == sorted(map(str, theirs.collect()))
    assert features.category_index(df.limit(0), ("name",)).collect() == []


def test_category_index_of_a_million_values(spark):
    df = spark.range(1_000_000).select(F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("name"))
    out = features.category_index(df.union(df.where("name = 'v0500000'")), ("name",))
    found = out.agg(F.count_distinct("name_index"), F.min("name_index"), F.max("name_index")).first()
    assert tuple(found) == (1_000_000, 0.0, 999_999.0)
    assert out.where("name = 'v0500000'").first().name_index == 0.0
    assert out.where("name = 'v0499999'").first().name_index == 500_000.0
