"""Geo-temporal trip cleaning, zone lookup and per-driver sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.expr import crossed, polygon_area, ring_pairs
from quarry.operators import ordered

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
def _epoch():
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _ts(c: str):
    return F.try_to_timestamp(F.col(c), F.lit(TS_FORMAT)).cast("timestamp_ntz")


def parse_trips(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """String trip records -> typed trips with a ``parsefailed`` flag.

    Input columns (strings): license, pickup_datetime, dropoff_datetime,
    pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude.
    A bad timestamp sets both times to the epoch; a bad coordinate sets both
    points to (0, 0); either sets ``parsefailed``.  No row is dropped here.
    ``keep`` names extra columns passed through unchanged.
    """
    pu, do = _ts("pickup_datetime"), _ts("dropoff_datetime")
    coords = [F.col(c).try_cast("double") for c in
              ("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")]
    t_ok = pu.isNotNull() & do.isNotNull()
    p_ok = coords[0].isNotNull()
    for c in coords[1:]:
        p_ok = p_ok & c.isNotNull()
    zero = F.lit(0.0)

    def pt(x, y):
        return F.struct(F.when(p_ok, x).otherwise(zero).alias("x"),
                        F.when(p_ok, y).otherwise(zero).alias("y"))

    return raw.select(
        *keep, F.col("license"),
        F.when(t_ok, pu).otherwise(_epoch()).alias("pickup_datetime"),
        F.when(t_ok, do).otherwise(_epoch()).alias("dropoff_datetime"),
        pt(coords[0], coords[1]).alias("pickup_loc"),
        pt(coords[2], coords[3]).alias("dropoff_loc"),
        (~(t_ok & p_ok)).alias("parsefailed"))


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col("parsefailed"))


def with_durations(trips: DataFrame) -> DataFrame:
    """Exact (microsecond) trip length in minutes and hours."""
    us = F.timestamp_diff("MICROSECOND", F.col("pickup_datetime"), F.col("dropoff_datetime"))
    mins = us.cast("double") / F.lit(60_000_000.0)
    return trips.withColumn("duration_mins", mins).withColumn("duration_hours", mins / F.lit(60.0))


def clean(trips: DataFrame, min_mins: float = 1.0, max_hours: float = 3.0) -> DataFrame:
    """Keep trips with duration_mins > min_mins and duration_hours < max_hours."""
    t = with_durations(trips)
    return t.where((F.col("duration_mins") > min_mins) & (F.col("duration_hours") < max_hours))


def drop_zero_points(trips: DataFrame) -> DataFrame:
    """Drop trips whose pickup or drop-off point is exactly (0, 0)."""
    def nonzero(p):
        return ~((F.col(p + ".x") == 0.0) & (F.col(p + ".y") == 0.0))
    return trips.where(nonzero("pickup_loc") & nonzero("dropoff_loc"))


# ------------------------------------------------------------------ zones

def zone_table(zones: DataFrame) -> DataFrame:
    """Zones (zone_code int, zone string, and ``rings``, all rings of all
    parts, or ``ring``, the only one) with a number, their bounding box and their
    priority: code ascending, then area descending (larger zone wins a tie;
    ``area`` where given, else the rings' sum)."""
    z = zones if "rings" in zones.columns else zones.withColumn("rings", F.array("ring"))
    if "area" not in z.columns:
        z = z.withColumn("area", F.aggregate(F.transform("rings", polygon_area), F.lit(0.0), lambda s, x: s + x))
    points = F.flatten("rings")
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    z = z.select(F.monotonically_increasing_id().alias("zone_no"), "zone_code", "zone", "rings", "area",
                 F.array_min(xs).alias("min_x"), F.array_max(xs).alias("max_x"),
                 F.array_min(ys).alias("min_y"), F.array_max(ys).alias("max_y"))
    # Priority as a sortable struct: lower code first, then larger area, then name.
    return z.withColumn("priority", F.struct(F.col("zone_code"), (-F.col("area")).alias("neg_area"),
                                             F.col("zone")))


def zone_cells(zt: DataFrame, w: float, h: float) -> DataFrame:
    """The zones' outlines dealt to a grid: (_cx, _cy, _zones), for each cell
    the zones that a point in it may lie in, with the edges to test and the
    parity of those that need no test.

    A point is inside where a ray to the right crosses an odd number of edges,
    of all rings together, so holes and several parts need nothing more.  In
    a row of cells an edge can be crossed from its own cells and those to their
    left.  From two cells to the left on, an edge that spans the row's whole
    height is crossed by every ray: it only turns the cell's parity.  Others
    stay in the cell's list.  A ring of any size is so spread over its cells.
    """
    size_x, size_y = F.lit(float(w)), F.lit(float(h))
    e = zt.select("zone_no", "priority", "zone", F.floor(F.col("min_x") / size_x).alias("left"),
                  F.explode(F.flatten(F.transform("rings", ring_pairs))).alias("e"))
    e = e.select("zone_no", "priority", "zone", "left", "e", F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"),
                 F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2")).where("y1 <> y2")  # level edges are never crossed
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    e = e.withColumn("_cy", F.explode(F.sequence(F.floor(low / size_y), F.floor(high / size_y))))
    # a margin of half a cell keeps rounding out of what needs no test
    spans = (low < (F.col("_cy") - 0.5) * size_y) & (high > (F.col("_cy") + 1.5) * size_y)
    e = e.withColumn("spans", spans).withColumn("_cx", F.explode(F.sequence(
        F.col("left"), F.floor(F.greatest("x1", "x2") / size_x))))
    sure = F.col("spans") & (F.col("_cx") + 1 < F.floor(F.least("x1", "x2") / size_x))
    per = e.groupBy("_cx", "_cy", "zone_no", "priority", "zone").agg(
        (F.sum(sure.cast("int")) % 2 == 1).alias("odd"), F.collect_list(F.when(~sure, F.col("e"))).alias("edges"))
    per = per.where(F.col("odd") | (F.size("edges") > 0))
    return per.groupBy("_cx", "_cy").agg(F.collect_list(F.struct("priority", "zone", "odd", "edges")).alias("_zones"))


def assign_zone(trips: DataFrame, zones: DataFrame, point: str = "dropoff_loc",
                default: str = "NA", cell: float | None = None) -> DataFrame:
    """First zone (by priority) whose polygons contain ``point``, else ``default``.

    The zones' edges are dealt to a grid (``zone_cells``); each trip joins its
    one cell and picks its first containing zone from the list, in place.
    Cells are as large as the average box (and at least 1/64 of the largest,
    so that one zone covers few columns), whatever the unit of the
    coordinates.  A cell with a large share of the trips is one skewed key of a
    left join, which AQE splits - or the cell table is small and AQE
    broadcasts it.
    """
    from quarry.session import shared_dir
    shared_dir(trips.sparkSession)
    zt = zone_table(zones).checkpoint()
    x, y = F.col(point + ".x"), F.col(point + ".y")
    wide, high = F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y")
    w, h = zt.agg(*[F.greatest(F.avg(c), F.max(c) / 64, F.lit(1e-9)) for c in (wide, high)]).first()
    w, h = (cell or w or 1.0, cell or h or 1.0)
    cells = zone_cells(zt, w, h)
    t = (trips.withColumn("_cx", F.floor(x / F.lit(float(w)))).withColumn("_cy", F.floor(y / F.lit(float(h))))
         .join(cells, ["_cx", "_cy"], "left"))
    inside = F.filter("_zones", lambda z: crossed(x, y, z["edges"], z["odd"]))
    best = F.array_min(F.transform(inside, lambda z: F.struct(z["priority"].alias("p"), z["zone"].alias("z"))))
    return t.withColumn("zone", F.coalesce(best["z"], F.lit(default))).drop("_zones", "_cx", "_cy")


# --------------------------------------------------------------- sessions

def next_trip(trips: DataFrame, license: str = "license", order: str = "pickup_datetime",
              tie: str = "trip_id") -> DataFrame:
    """Each trip with the next trip of the same license (sliding pair, n=2);
    the last trip of each license has no successor and is dropped.

    Ordered per (license, day) with day boundaries stitched (see
    ``ordered.next_in_order``), so a license with a huge share of the trips
    is spread over its days instead of sorted in one task.
    """
    x = ordered.next_in_order(trips, license, [order, tie], [order, tie], F.to_date(order), "next_")
    return (x.withColumnRenamed("next_" + order, "next_pickup")
            .withColumnRenamed("next_" + tie, "next_trip_id")
            .where(F.col("next_pickup").isNotNull()))


def gap_minutes(pairs: DataFrame) -> DataFrame:
    """Minutes from this trip's drop-off to the next pickup."""
    us = F.timestamp_diff("MICROSECOND", F.col("dropoff_datetime"), F.col("next_pickup"))
    return pairs.withColumn("gap_mins", us.cast("double") / F.lit(60_000_000.0))


def idle_by_zone(trips: DataFrame, shift_gap_hours: float = 4.0, within: bool = True) -> DataFrame:
    """(zone, gap_mins) per consecutive trip pair of a license.

    within=True: pairs inside a shift (0 <= gap < 4 h); within=False: the
    pairs that split shifts (gap >= 4 h).  Overlapping trips (negative gap)
    are in neither.
    """
    g = gap_minutes(next_trip(trips))
    lim = shift_gap_hours * 60.0
    cond = ((F.col("gap_mins") >= 0) & (F.col("gap_mins") < lim)) if within \
        else (F.col("gap_mins") >= lim)
    return g.where(cond)


def sessionize(trips: DataFrame, license: str = "license", order: str = "pickup_datetime",
               tie: str = "trip_id", shift_gap_hours: float = 4.0) -> DataFrame:
    """Session (shift) number per license: a new shift starts after a gap of
    at least ``shift_gap_hours`` since the previous drop-off.  Previous-row
    lookup and the running count are both split by (license, day)."""
    day = F.to_date(order)
    x = ordered.prev_in_order(trips, license, [order, tie], ["dropoff_datetime"], day, "prev_")
    gap_h = F.timestamp_diff("MICROSECOND", F.col("prev_dropoff_datetime"), F.col(order)).cast("double") / 3.6e9
    x = x.withColumn("_brk", F.when(gap_h >= shift_gap_hours, 1).otherwise(0))
    x = ordered.running_sum(x, license, [order, tie], "_brk", F.to_date(order), "session")
    return x.drop("_brk", "prev_dropoff_datetime")


def sliding_tuples(trips: DataFrame, n: int, license: str = "license",
                   order: str = "pickup_datetime", tie: str = "trip_id") -> DataFrame:
    """Sliding windows of n consecutive trips per license: the trip ids of
    each full window (shorter windows at the end are dropped).  Built by
    following successor links: n - 2 equi-joins on the unique trip id."""
    nxt = next_trip(trips, license, order, tie).select(license, F.col(tie).alias("first_id"),
                                                       F.array(F.col(tie), F.col("next_trip_id")).alias("window_ids"),
                                                       F.col("next_trip_id").alias("_last"))
    links = next_trip(trips, license, order, tie).select(F.col(tie).alias("_last"),
                                                         F.col("next_trip_id").alias("_nn"))
    out = nxt
    for _ in range(n - 2):
        out = (out.join(links, "_last")
               .select(license, "first_id", F.concat("window_ids", F.array("_nn")).alias("window_ids"),
                       F.col("_nn").alias("_last")))
    return out.drop("_last")
