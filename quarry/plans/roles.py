"""Stand-ins: the inputs each application expects, derived from the driver's
tables by Spark (so every query's work grows with the tables).

Each function takes (spark, sf_dir) and returns a DataFrame with the column
names the operators use.  The role mapping is documented in FIXTURES.md §3.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sources.tables import table


def basket_items(spark: SparkSession, d: str) -> DataFrame:
    """Citation -> topics stand-in: order -> part name per line (multiplicity kept)."""
    li = table(spark, d, "lineitem", "l_orderkey", "l_partkey")
    pt = table(spark, d, "part", "p_partkey", "p_name")
    return (li.join(pt, li.l_partkey == pt.p_partkey)
            .select(F.col("l_orderkey").alias("basket"), F.col("p_name").alias("topic")))


def basket_total(spark: SparkSession, d: str):
    """Number of citations (orders, with or without lines) as a scalar subquery."""
    return table(spark, d, "orders", "o_orderkey").select(F.count(F.lit(1))).scalar()


# ----------------------------------------------------------------- trips

TRIP_COLUMNS = ("trip_id", "license", "vendor_id", "pickup_datetime", "dropoff_datetime",
                "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")


def trip_records(spark: SparkSession, d: str) -> DataFrame:
    """Trip CSV records (all strings) derived from events: license = user,
    pickup = ts, drop-off = ts + value minutes, points from (event_id % 100, k).
    'error' events carry an unparsable pickup time and short 'view' events a
    non-numeric longitude, so both failure paths are exercised."""
    ev = table(spark, d, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    k = F.get_json_object("props", "$.k").cast("int")
    cell = F.pmod(F.col("event_id"), F.lit(100))
    drop_ts = F.timestamp_add("MICROSECOND", F.round(F.col("value") * 60_000_000.0).cast("long"),
                              F.col("ts"))
    fmt = "yyyy-MM-dd HH:mm:ss"
    return ev.select(
        F.col("event_id").cast("string").alias("trip_id"),
        F.col("user_id").cast("string").alias("license"),
        F.col("event_type").alias("vendor_id"),
        F.when(F.col("event_type") == "error", F.lit("not a time"))
         .otherwise(F.date_format("ts", fmt)).alias("pickup_datetime"),
        F.date_format(drop_ts, fmt).alias("dropoff_datetime"),
        F.when((F.col("event_type") == "view") & (F.col("value") < 20), F.lit("n/a"))
         .otherwise(cell.cast("string")).alias("pickup_longitude"),
        k.cast("string").alias("pickup_latitude"),
        k.cast("string").alias("dropoff_longitude"),
        cell.cast("string").alias("dropoff_latitude"))


def trip_csv(spark: SparkSession, d: str) -> str:
    """Write the trip records as headed CSV to the shared folder; return the path."""
    from quarry.session import stand_in_source
    from quarry.sources.files import write_csv
    return stand_in_source(spark, "trips", d, lambda p: write_csv(trip_records(spark, d), p))


def read_trip_csv(spark: SparkSession, path: str) -> DataFrame:
    from quarry.sources.files import read_csv, string_schema
    return read_csv(spark, path, string_schema(*TRIP_COLUMNS), header=True)


# Literal zones in the 0-100 plane (code, name, closed ring).
# Zones 2 and 4 overlap; code 5 has two polygons of different area.
ZONES = [
    (1, "North", [(0, 0), (40, 0), (40, 50), (0, 50), (0, 0)]),
    (2, "East", [(40, 0), (100, 0), (100, 30), (70, 45), (40, 30), (40, 0)]),
    (3, "South", [(0, 50), (60, 50), (0, 100), (0, 50)]),
    (4, "West", [(60, 40), (100, 40), (100, 100), (50, 100), (60, 40)]),
    (5, "Island", [(20, 80), (45, 80), (45, 95), (20, 95), (20, 80)]),
    (5, "Islet", [(30, 85), (35, 85), (35, 90), (30, 90), (30, 85)]),
]


def zones_geojson_text() -> str:
    import json
    feats = [{"type": "Feature",
              "properties": {"boroughCode": str(code), "borough": name},
              "geometry": {"type": "Polygon", "coordinates": [[[float(x), float(y)] for x, y in ring]]}}
             for code, name, ring in ZONES]
    return json.dumps({"type": "FeatureCollection", "features": feats}, indent=1)


def zones(spark: SparkSession) -> DataFrame:
    """Zones from a GeoJSON FeatureCollection written to the shared folder and
    read back (multi-line JSON, one row per feature)."""
    from quarry.session import stand_in_source
    from quarry.sources.formats import geojson_zones
    path = stand_in_source(spark, "zones", "", lambda p: spark.createDataFrame(
        [(zones_geojson_text(),)], "value string").coalesce(1).write.mode("overwrite").text(p))
    return geojson_zones(spark, path)


# --------------------------------------------------------------- linkage

LINK_FIELDS = ["f_band", "f_tail", "f_cents"]


def linkage_records(spark: SparkSession, d: str) -> DataFrame:
    """Customers as linkage records: block = nation, label = segment, three
    compared fields; a negative balance makes f_band and f_cents missing."""
    c = table(spark, d, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    ok = F.col("c_acctbal") >= 0
    return c.select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("block"),
        F.col("c_mktsegment").alias("segment"),
        F.when(ok, F.floor(F.col("c_acctbal") / 1000.0)).alias("f_band"),
        F.substring("c_name", -1, 1).alias("f_tail"),
        F.when(ok, F.pmod(F.round(F.col("c_acctbal") * 100.0).cast("long"), F.lit(10))).alias("f_cents"))


PAIR_FIELDS = ["s_nation", "s_zone", "s_name", "s_decade", "s_balance", "s_band", "s_cents", "s_sign", "s_tens"]
LINK_HEADER = '"id","block","f_band","f_tail","f_cents","segment"'


def linkage_lines(spark: SparkSession, d: str) -> DataFrame:
    """The records as CSV text with a quoted header line and '?' for missing."""
    r = linkage_records(spark, d)
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("?"))
             for c in ("id", "block", "f_band", "f_tail", "f_cents", "segment")]
    body = r.select(F.concat_ws(",", *cells).alias("value"))
    head = spark.createDataFrame([(LINK_HEADER,)], "value string")
    return head.unionByName(body)


def pair_lines(spark: SparkSession, d: str) -> DataFrame:
    """Candidate record pairs as CSV text: customers with neighbouring numbers,
    nine comparison scores ('?' = missing), TRUE where their segments agree,
    and a quoted header line inside the data.  Scores are 1 or 0 for agreement,
    but the fifth, a similarity of the balances in hundredths."""
    c = table(spark, d, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    a = c.select([F.col(x).alias(x.replace("c_", "a_")) for x in c.columns])
    b = c.select([F.col(x).alias(x.replace("c_", "b_")) for x in c.columns])
    p = a.join(b, F.col("b_custkey") == F.col("a_custkey") + 1)
    ok = (F.col("a_acctbal") >= 0) & (F.col("b_acctbal") >= 0)

    def cents(x):
        return F.round(F.col(x) * 100.0).cast("long")

    def same(x, y):
        return F.when(x == y, 1).otherwise(0)
    gap = F.abs(cents("a_acctbal") - cents("b_acctbal"))
    near = F.greatest(F.lit(0), F.lit(100) - F.floor(gap / F.lit(10000.0)).cast("int"))
    scores = [same(F.col("a_nationkey"), F.col("b_nationkey")),
              same(F.col("a_nationkey") % 5, F.col("b_nationkey") % 5),
              same(F.substring("a_name", -1, 1), F.substring("b_name", -1, 1)),
              same(F.floor(F.col("a_custkey") / 10), F.floor(F.col("b_custkey") / 10)),
              F.when(ok, near.cast("double") / 100.0),
              F.when(ok, same(F.floor(F.col("a_acctbal") / 1000.0), F.floor(F.col("b_acctbal") / 1000.0))),
              F.when(ok, same(F.pmod(cents("a_acctbal"), F.lit(10)), F.pmod(cents("b_acctbal"), F.lit(10)))),
              same(F.col("a_acctbal") >= 0, F.col("b_acctbal") >= 0),
              F.when(F.col("a_nationkey") < 20, same(F.substring("a_name", -2, 1), F.substring("b_name", -2, 1)))]
    same_segment = F.when(F.col("a_mktsegment") == F.col("b_mktsegment"), "TRUE").otherwise("FALSE")
    body = p.select(F.concat_ws(",", F.col("a_custkey").cast("string"), F.col("b_custkey").cast("string"),
                                *[F.coalesce(x.cast("string"), F.lit("?")) for x in scores], same_segment).alias("value"))
    names = ["id1", "id2", *PAIR_FIELDS, "matched"]
    return spark.createDataFrame([(",".join(f'"{x}"' for x in names),)], "value string").unionByName(body)


# ------------------------------------------------------------ citations XML

def citation_records(spark: SparkSession, d: str) -> DataFrame:
    """One citation element per order line: PMID = order, one MeshHeading whose
    DescriptorName is the part name; it is a major topic when quantity >= 25."""
    li = table(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_quantity")
    pt = table(spark, d, "part", "p_partkey", "p_name")
    x = li.join(pt, li.l_partkey == pt.p_partkey)
    name = F.struct(F.col("p_name").alias("_VALUE"),
                    F.when(F.col("l_quantity") >= 25, "Y").otherwise("N").alias("_MajorTopicYN"))
    heading = F.struct(name.alias("DescriptorName"))
    return x.select(F.col("l_orderkey").alias("PMID"),
                    F.struct(F.array(heading).alias("MeshHeading")).alias("MeshHeadingList"))


def citation_schema():
    from pyspark.sql import types as T
    name = T.StructType([T.StructField("_VALUE", T.StringType()),
                         T.StructField("_MajorTopicYN", T.StringType())])
    heading = T.StructType([T.StructField("DescriptorName", name)])
    hlist = T.StructType([T.StructField("MeshHeading", T.ArrayType(heading))])
    return T.StructType([T.StructField("PMID", T.LongType()),
                         T.StructField("MeshHeadingList", hlist)])


#: citations of one file: a whole-text scan holds a file at a time
CITATIONS = 10_000


def citation_xml(spark: SparkSession, d: str) -> str:
    """Write the citations as gzip XML (root MedlineCitationSet) to the shared folder."""
    from quarry.session import stand_in_source
    from quarry.sources.files import write_xml
    return stand_in_source(spark, "citations", d, lambda p: write_xml(
        citation_records(spark, d), p, "MedlineCitation", "MedlineCitationSet", compression="gzip",
        max_records=CITATIONS))


# ------------------------------------------------------------------- risk

# The analysis window.  It spans every order date (start is a
# Saturday before the first order, so the start is padded with the first
# price; end is after the last order).
RISK_START, RISK_END = "1994-12-31", "2001-08-03"


def stock_quotes(spark: SparkSession, d: str) -> DataFrame:
    """Instrument = order priority; price = daily mean order total."""
    from quarry.operators.risk import daily_quotes
    o = table(spark, d, "orders", "o_orderpriority", "o_orderdate", "o_totalprice")
    return daily_quotes(o, "o_orderpriority", "o_orderdate", "o_totalprice", scale=100)


def factor_quotes(spark: SparkSession, d: str) -> DataFrame:
    """Factor = customer segment; price = daily mean order total."""
    from quarry.operators.risk import daily_quotes
    o = table(spark, d, "orders", "o_custkey", "o_orderdate", "o_totalprice")
    c = table(spark, d, "customer", "c_custkey", "c_mktsegment")
    x = o.join(c, o.o_custkey == c.c_custkey)
    return daily_quotes(x, "c_mktsegment", "o_orderdate", "o_totalprice", scale=100)


def fine_factor_quotes(spark: SparkSession, d: str) -> DataFrame:
    """Factor = customer nation, segment and order priority (some 625 factors);
    price = daily mean order total."""
    from quarry.operators.risk import daily_quotes
    return daily_quotes(_fine_orders(spark, d), "factor", "o_orderdate", "o_totalprice", scale=100)


def _fine_orders(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    c = table(spark, d, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    factor = F.concat_ws("|", "c_nationkey", "c_mktsegment", "o_orderpriority").alias("factor")
    return o.join(c, o.o_custkey == c.c_custkey).select(factor, "o_orderdate", "o_totalprice")


def fine_factor_weights(spark: SparkSession, d: str) -> DataFrame:
    """A portfolio holding each factor by its share of the order value."""
    x = _fine_orders(spark, d).groupBy("factor").agg(F.sum("o_totalprice").alias("value"))
    total = x.select(F.sum("value")).scalar()
    return x.select("factor", F.lit(0.0).alias("square"), F.lit(0.0).alias("root"), (F.col("value") / total).alias("raw"))


def price_files(spark: SparkSession, d: str, path: str) -> str:
    """The stock quotes as one folder of CSV files per instrument, newest
    first, dates as dd-MMM-yyyy; each instrument's first day has a second row
    without a price."""
    q = stock_quotes(spark, d)
    bad = q.groupBy("instrument").agg(F.min("date").alias("date")).withColumn("price", F.lit(None).cast("double"))
    x = q.unionByName(bad)
    x = x.repartitionByRange("instrument", F.col("date").desc()).sortWithinPartitions("instrument", F.col("date").desc())
    (x.select("instrument", F.date_format("date", "dd-MMM-yyyy").alias("date"),
              F.coalesce(F.col("price").cast("string"), F.lit("-")).alias("open"))
     .write.mode("overwrite").option("header", True).partitionBy("instrument").csv(path))
    return path


def trials(spark: SparkSession, d: str) -> DataFrame:
    """One Monte Carlo trial per order: the trial count grows with the data."""
    return table(spark, d, "orders", "o_orderkey").select(F.col("o_orderkey").alias("trial"))


# -------------------------------------------------------------- recommend

def plays(spark: SparkSession, d: str) -> DataFrame:
    """(user, item, count): customer, part, number of order lines."""
    li = table(spark, d, "lineitem", "l_orderkey", "l_partkey")
    o = table(spark, d, "orders", "o_orderkey", "o_custkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"))
            .agg(F.count(F.lit(1)).alias("count")))


def plays_lines(spark: SparkSession, d: str) -> DataFrame:
    """The plays as space-separated text lines 'user item count'."""
    p = plays(spark, d)
    return p.select(F.concat_ws(" ", "user", "item", "count").alias("value"))


def alias_lines(spark: SparkSession, d: str) -> DataFrame:
    """'bad<TAB>good' lines: every part maps to the smallest part with the same
    (name, brand); parts of size 1 add a blank-id line (to be dropped)."""
    p = table(spark, d, "part", "p_partkey", "p_name", "p_brand", "p_size")
    good = p.groupBy("p_name", "p_brand").agg(F.min("p_partkey").alias("good"))
    x = p.join(good, ["p_name", "p_brand"]).where(F.col("p_partkey") != F.col("good"))
    body = x.select(F.concat_ws("\t", "p_partkey", "good").alias("value"))
    blanks = p.where(F.col("p_size") == 1).select(F.concat(F.lit("\t"), F.col("p_partkey").cast("string")).alias("value"))
    return body.unionByName(blanks)


def artist_lines(spark: SparkSession, d: str) -> DataFrame:
    """'id<TAB>name' lines with dirt: size-2 parts get a non-numeric id and
    size-3 parts lose their tab; names carry spaces to be trimmed."""
    p = table(spark, d, "part", "p_partkey", "p_name", "p_size")
    idc = F.when(F.col("p_size") == 2, F.concat(F.lit("x"), F.col("p_partkey").cast("string"))) \
        .otherwise(F.col("p_partkey").cast("string"))
    sep = F.when(F.col("p_size") == 3, F.lit(" ")).otherwise(F.lit("\t"))
    return p.select(F.concat(idc, sep, F.lit("  "), F.col("p_name"), F.lit(" ")).alias("value"))


# ------------------------------------------------------------------ graph

def handoff_edges(spark: SparkSession, d: str) -> DataFrame:
    """Directed supplier hand-off: supplier of line n -> supplier of line n + 1
    of the same order (self-loops dropped).  Output (src, dst, cnt)."""
    a = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey")
    b = a.select(F.col("l_orderkey").alias("o"), (F.col("l_linenumber") - 1).alias("n"),
                 F.col("l_suppkey").alias("dst"))
    h = (a.select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("n"),
                  F.col("l_suppkey").alias("src"))
         .join(b, ["o", "n"]).where(F.col("src") != F.col("dst")))
    return h.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("cnt"))


def supplier_vertices(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier", "s_suppkey").select(F.col("s_suppkey").alias("id"))


# ------------------------------------------------------------------- text

def corpus(spark: SparkSession, d: str) -> DataFrame:
    """The article corpus: every document (all languages), whole texts."""
    return table(spark, d, "documents", "doc_id", "text")


# -------------------------------------------------------------- classify

# The five market segments, in one-hot flag order.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
N_NATIONS = 25
EMBEDDING = 64  # components of an embedding
NUMERIC = [f"e{i}" for i in range(EMBEDDING)]
WILD = [f"w{i}" for i in range(len(SEGMENTS))]
SOIL = [f"s{i}" for i in range(N_NATIONS)]
COVER_COLUMNS = NUMERIC + WILD + SOIL + ["label"]


def cover_rows(spark: SparkSession, d: str) -> DataFrame:
    """Forest-cover-like rows, one per embedding: its components as numerics,
    one-hot 'wilderness' (segment) and 'soil' (nation) flags, 1-based label
    last.  The flags are those of the customer whose place in the key order is
    the vector's id modulo the number of customers: no embedding is lost."""
    from quarry.operators.recommend import item_index
    e = table(spark, d, "embeddings", "vec_id", "embedding", "label")
    c = table(spark, d, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    place = item_index(c.select(F.col("c_custkey").alias("item"))).withColumnRenamed("item", "c_custkey")
    c = c.join(place, "c_custkey")
    n = table(spark, d, "customer", "c_custkey").agg(F.count(F.lit(1)).alias("n")).scalar()
    x = e.withColumn("idx", F.pmod("vec_id", n)).join(c, "idx", "left")
    flag = lambda cond: F.coalesce(cond, F.lit(False)).cast("int")
    cols = [F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(EMBEDDING)]
    cols += [flag(F.col("c_mktsegment") == s).alias(WILD[i]) for i, s in enumerate(SEGMENTS)]
    cols += [flag(F.col("c_nationkey") == i).alias(SOIL[i]) for i in range(N_NATIONS)]
    return x.select("vec_id", *cols, (F.col("label") + 1).alias("label"))


def cover_file(spark: SparkSession, d: str) -> DataFrame:
    """The rows written as header-less CSV and read back with an explicit schema."""
    from pyspark.sql import types as T
    from quarry.session import stand_in_source
    from quarry.sources.files import read_csv, write_csv
    path = stand_in_source(spark, "cover", d, lambda p: write_csv(cover_rows(spark, d), p, header=False))
    fields = [T.StructField("vec_id", T.LongType())]
    fields += [T.StructField(c, T.DoubleType()) for c in NUMERIC]
    fields += [T.StructField(c, T.IntegerType()) for c in WILD + SOIL + ["label"]]
    return read_csv(spark, path, T.StructType(fields), header=False)


def split_of(key: str = "vec_id"):
    """Deterministic 80/10/10 split: 'train', 'cv', 'test' from a hash of the key."""
    from quarry.functions.expr import hash_int
    b = F.pmod(hash_int(F.col(key), F.lit("split")), F.lit(10))
    return F.when(b < 8, "train").when(b == 8, "cv").otherwise("test")


# ---------------------------------------------------------------- anomaly

def network_records(ev: DataFrame) -> DataFrame:
    """(event_id, event_type, k, value) from events (batch or stream)."""
    return ev.select("event_id", "event_type",
                     F.get_json_object("props", "$.k").cast("double").alias("k"), "value")
