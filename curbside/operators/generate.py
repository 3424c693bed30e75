"""Synthetic update batches that continue a dataset's history.

All noise comes from hashes of the row's own values, so a batch is the same on every run and on
any cluster.
"""

from __future__ import annotations

import zlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbside.functions.bands import piecewise_index
from curbside.functions.hashing import key_columns, uniform
from curbside.operators.ordered import last_n, latest_per_key

# Default seed, shares and jitter widths of generated trips.
SEED = 20260923
NEW_FRACTION = 0.07
DUPLICATE_FRACTION = 0.015
FARE_JITTER = 0.05
DISTANCE_JITTER = 0.10
PASSENGER_JITTER_PROBABILITY = 0.20
NEW_HOURS = 24 * 7


def stream_seed(seed: int, name: str) -> int:
    """The seed of a named stream of draws, so that draws of one row are independent."""
    return seed + zlib.crc32(name.encode())


def hash_sample(df: DataFrame, fraction: float, seed: int, keys: Sequence[str]) -> DataFrame:
    """Bernoulli sample decided by the row's key values."""
    return df.where(uniform(seed, *key_columns(df, keys)) < fraction)


def _shift(ts: Column, seconds: Column) -> Column:
    return ts + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def _seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def time_bounds(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))


def trip_update(
    trips: DataFrame,
    keys: Sequence[str],
    seed: int = SEED,
    new_fraction: float = NEW_FRACTION,
    duplicate_fraction: float = DUPLICATE_FRACTION,
    pickup: str = "tpep_pickup_datetime",
    dropoff: str = "tpep_dropoff_datetime",
    window_s: int | None = None,
) -> DataFrame:
    """New trips that follow the last known pickup, plus verbatim duplicates of old ones.

    `trips` is read twice, once for its bounds and once for all rows of the update. The earliest sampled pickup lands one second after the newest original one. Without
    `window_s` the new trips are spread so that their density matches the history.
    """
    row_key = key_columns(trips, keys)

    def draw(stream: str) -> Column:
        return uniform(stream_seed(seed, stream), *row_key)

    sampled = draw("new") < new_fraction
    bounds = trips.agg(
        F.min(pickup).alias("lo"),
        F.max(pickup).alias("hi"),
        F.min(F.when(sampled, F.col(pickup))).alias("sample_lo"),
    ).select(
        (_seconds_between(F.coalesce("sample_lo", "lo"), F.col("hi")) + 1).alias("shift_s"),
        _seconds_between(F.col("lo"), F.col("hi")).alias("span_s"),
    )
    base = bounds.first()  # one row
    if base.shift_s is None:
        raise ValueError(f"no {pickup} bounds: the data set is empty")
    window = window_s if window_s is not None else int(base.span_s * new_fraction)
    moved = F.lit(base.shift_s) + F.floor(draw("delay") * window)
    turn = F.when(draw("direction") < 0.5, -1).otherwise(1)
    step = F.when(draw("passengers") < PASSENGER_JITTER_PROBABILITY, turn).otherwise(0)
    passengers = F.greatest(F.lit(1), F.col("passenger_count") + step)
    # all new values are computed from the old row, hence one projection
    changed = {
        pickup: _shift(F.col(pickup), moved),
        dropoff: _shift(F.col(dropoff), moved),
        "fare_amount": F.col("fare_amount") * ((draw("fare") * 2 - 1) * FARE_JITTER + 1),
        "trip_distance": F.col("trip_distance") * ((draw("distance") * 2 - 1) * DISTANCE_JITTER + 1),
        "passenger_count": passengers.cast(trips.schema["passenger_count"].dataType),
    }
    copied = draw("copy") < duplicate_fraction
    kinds = F.filter(F.array(F.when(sampled, F.lit(True)), F.when(copied, F.lit(False))), lambda kind: kind.isNotNull())
    rows = trips.where(sampled | copied).withColumn("_new", F.explode(kinds))
    return rows.select(
        *[F.when(F.col("_new"), changed[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c) for c in trips.columns]
    )


def latest_expanded(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], hours: int, shifted: Mapping[str, str]
) -> DataFrame:
    """The newest row of each key, repeated for 1..hours with its times moved on.

    `shifted` maps time columns to the names of their moved forms. The offsets are exploded from
    a constant array: a fixed fan-out, no join.
    """
    templates = latest_per_key(df, keys, order)
    out = templates.withColumn("offset_h", F.explode(F.sequence(F.lit(1), F.lit(hours))))
    moves = {new: F.col(old) + F.make_dt_interval(hours=F.col("offset_h")) for old, new in shifted.items()}
    return out.withColumns(moves)


def air_update(raw: DataFrame, hours: int = NEW_HOURS, seed: int = SEED) -> DataFrame:
    """Hourly measurements after each monitor's newest row with readable times, with noise and the index column."""
    site = ["state_code", "county_code", "site_num", "poc"]

    def moment(kind: str) -> Column:
        text = F.concat_ws(" ", F.col(f"date_{kind}").cast("string"), F.col(f"time_{kind}"))
        return F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm")).cast("timestamp_ntz")

    # rows without a readable time cannot be moved on
    timed = raw.withColumns({"_gmt": moment("gmt"), "_local": moment("local")}).where(
        F.col("_gmt").isNotNull() & F.col("_local").isNotNull()
    )
    grown = latest_expanded(
        timed, site, [F.col("_gmt").desc_nulls_last(), *[F.col(c) for c in raw.columns]], hours,
        {"_gmt": "_new_gmt", "_local": "_new_local"},
    )
    noise = uniform(seed, *key_columns(grown, [*site, "offset_h"])) * 6.0 - 3.0
    out = grown.withColumns(
        {
            "sample_measurement": F.greatest(F.lit(0.0), F.round(F.col("sample_measurement") + noise, 1)),
            "date_gmt": F.to_date("_new_gmt").cast(raw.schema["date_gmt"].dataType),
            "time_gmt": F.date_format("_new_gmt", "HH:mm"),
            "date_local": F.to_date("_new_local").cast(raw.schema["date_local"].dataType),
            "time_local": F.date_format("_new_local", "HH:mm"),
        }
    )
    return out.withColumn("aqi", piecewise_index(F.col("sample_measurement"))).select(*raw.columns, "aqi")


def replay_last(
    df: DataFrame, order_ts: str, tie: Sequence[str], hours: int, templates: int
) -> DataFrame:
    """The newest `templates` rows, newest first, replayed cyclically over the next `hours`.

    Adds `offset_h` and `new_ts`. Template k serves the offsets congruent to k, so each template
    explodes into its own offsets; only the bounded set of templates is ever numbered.
    """
    ordered = [F.col(order_ts).desc(), *[F.col(c) for c in tie]]
    everything = Window.partitionBy()  # over the bounded set of templates
    rows = last_n(df, templates, ordered).withColumns(
        {
            "_k": F.row_number().over(everything.orderBy(*ordered)) - 1,
            "_n": F.count("*").over(everything).cast("int"),
            "_newest": F.max(order_ts).over(everything),
        }
    )
    out = rows.where(F.col("_k") < hours).select(
        *df.columns, "_newest",
        F.explode(F.sequence(F.col("_k") + 1, F.lit(hours), F.col("_n"))).alias("offset_h"),
    )
    return out.withColumn("new_ts", F.col("_newest") + F.make_dt_interval(hours=F.col("offset_h"))).drop("_newest")


def weather_update(raw: DataFrame, hours: int = NEW_HOURS, seed: int = SEED) -> DataFrame:
    """The last week of observations replayed with noise, plus the new `humidity` column."""
    parts = [F.col(c).cast("int") for c in ("year", "month", "day", "hour")]
    timed = raw.withColumn("_ts", F.try_make_timestamp_ntz(*parts, F.lit(0), F.lit(0)))
    replayed = replay_last(timed.where(F.col("_ts").isNotNull()), "_ts", raw.columns, hours, hours)

    def draw(k: int, lo: float, hi: float) -> Column:
        return uniform(seed + k, "offset_h") * (hi - lo) + lo

    types = {f.name: f.dataType for f in raw.schema.fields}
    new = F.col("new_ts")
    # How far each measurement may move.
    changed: dict[str, Column] = {
        "year": F.year(new), "month": F.month(new), "day": F.dayofmonth(new), "hour": F.hour(new)
    }
    for k, (name, spread) in enumerate({"temp": 1.5, "wspd": 2.0, "pres": 1.0}.items()):
        if name in types:
            changed[name] = F.round(F.col(name) + draw(k, -spread, spread), 2)
    if "prcp" in types:
        rain = F.coalesce(F.col("prcp"), F.lit(0.0)) + draw(3, -0.2, 0.5)
        changed["prcp"] = F.round(F.greatest(F.lit(0.0), rain), 2)
    if "wdir" in types:
        changed["wdir"] = F.pmod(F.col("wdir").cast("int") + F.floor(draw(4, -20, 21)), F.lit(360))
    columns = [changed[c].cast(types[c]).alias(c) if c in changed else F.col(c) for c in raw.columns]
    return replayed.select(*columns, F.round(draw(5, 20.0, 100.0), 1).alias("humidity"))
