"""Trip parsing, cleaning, zone lookup and per-license session queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import trips
from quarry.plans import roles
from quarry.plans.registry import query, r4


def _parsed_trips(spark, d):
    raw = roles.read_trip_csv(spark, roles.trip_csv(spark, d))
    p = trips.parse_trips(raw, keep=("trip_id",))
    return p.withColumn("trip_id", F.col("trip_id").cast("long"))


def _flat_points(df):
    return df.select("*", F.col("pickup_loc.x").alias("pickup_x"), F.col("pickup_loc.y").alias("pickup_y"),
                     F.col("dropoff_loc.x").alias("dropoff_x"), F.col("dropoff_loc.y").alias("dropoff_y")) \
        .drop("pickup_loc", "dropoff_loc")


def _clean_trips(spark, d):
    return trips.clean(trips.good_rows(_parsed_trips(spark, d)))


def _zoned_trips(spark, d):
    return trips.assign_zone(_clean_trips(spark, d), roles.zones(spark), "dropoff_loc")


def _trips_done(spark, d):
    z = _zoned_trips(spark, d).where(F.col("zone") != "NA")
    return trips.drop_zero_points(z)


@query("parse_good_bad")
def parse_good_bad(spark, d):
    return _flat_points(_parsed_trips(spark, d))


@query("clean_durations")
def clean_durations(spark, d):
    return _clean_trips(spark, d).select("trip_id", "license", r4("duration_mins").alias("duration_mins"),
                                         r4("duration_hours").alias("duration_hours"))


@query("zone_lookup")
def zone_lookup(spark, d):
    return _zoned_trips(spark, d).select("trip_id", "zone")


@query("zone_counts")
def zone_counts(spark, d):
    z = _zoned_trips(spark, d).where(F.col("zone") != "NA")
    return z.groupBy("zone").agg(F.count(F.lit(1)).alias("cnt"))


def _idle(spark, d, within):
    g = trips.idle_by_zone(_trips_done(spark, d), 4.0, within)
    return g.select("trip_id", "license", "zone", r4("gap_mins").alias("gap_mins"))


@query("idle_within_shift")
def idle_within_shift(spark, d):
    return _idle(spark, d, True)


@query("idle_between_shifts")
def idle_between_shifts(spark, d):
    return _idle(spark, d, False)


@query("trip_sessions")
def trip_sessions(spark, d):
    return trips.sessionize(_trips_done(spark, d)).select("trip_id", "license", "session")


@query("sliding_tuples")
def sliding_tuples(spark, d):
    s = trips.sliding_tuples(_trips_done(spark, d), 3)
    return s.select("license", "first_id",
                    F.concat_ws(",", F.transform("window_ids", lambda x: x.cast("string"))).alias("window_ids"))
