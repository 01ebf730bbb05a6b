"""Readers for the applications' own input formats, with explicit schemas.

Each returns a DataFrame in the column layout the operators take, so the
library runs on the original inputs as well as on the fixture stand-ins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.expr import polygon_area
from quarry.sources.files import drop_header_lines, read_csv, read_lines, string_schema

# The formats' layouts.  Record-pair files carry nine comparison
# scores; the taxi CSV header lists these columns in this order; citation XML
# uses MedlineCitation / MeshHeadingList / MeshHeading / DescriptorName with the
# MajorTopicYN attribute.
LINKAGE_SCORES = 9


def linkage_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Record-pair CSV: id1, id2, nine comparison scores ('?' = missing),
    matched ('TRUE' / 'FALSE'); a quoted header line may appear anywhere.
    Output (id1, id2, scores array<double>, matched boolean)."""
    lines = drop_header_lines(read_lines(spark, path))
    a = F.split("value", ",")
    scores = [F.when(a[i] != "?", a[i]).try_cast("double") for i in range(2, 2 + LINKAGE_SCORES)]
    return lines.select(a[0].try_cast("long").alias("id1"), a[1].try_cast("long").alias("id2"),
                        F.array(*scores).alias("scores"),
                        (a[2 + LINKAGE_SCORES] == "TRUE").alias("matched"))


def field_frequencies(spark: SparkSession, path: str) -> DataFrame:
    """Frequencies file: a quoted header line and one line of per-field
    chance-agreement probabilities.  The file is read whole (one row), and
    header names are linked to values by position: (pos, field, u)."""
    doc = read_lines(spark, path, whole_text=True).select(F.split(F.trim("value"), r"\r?\n").alias("ls"))
    hdr = F.filter("ls", lambda ln: ln.contains('"'))[0]
    val = F.filter("ls", lambda ln: ~ln.contains('"') & (F.length(F.trim(ln)) > 0))[0]
    names = F.transform(F.split(hdr, ","), lambda x: F.regexp_replace(x, '"', ""))
    z = doc.select(F.posexplode(F.arrays_zip(names.alias("field"), F.split(val, ",").alias("u"))).alias("pos", "p"))
    return z.select("pos", F.col("p.field").alias("field"), F.trim(F.col("p.u")).try_cast("double").alias("u"))


def plays(spark: SparkSession, path: str) -> DataFrame:
    """'user item count' lines (space separated) -> (user, item, count)."""
    schema = T.StructType([T.StructField("user", T.LongType()), T.StructField("item", T.LongType()),
                           T.StructField("count", T.LongType())])
    return read_csv(spark, path, schema, header=False, sep=" ")


def id_names(spark: SparkSession, path: str) -> DataFrame:
    """'id<TAB>name' lines, dirty ids dropped -> (id, name)."""
    from quarry.operators.recommend import parse_id_name
    return parse_id_name(read_lines(spark, path))


def aliases(spark: SparkSession, path: str) -> DataFrame:
    """'bad<TAB>good' lines, blank ids dropped -> (bad, good)."""
    from quarry.operators.recommend import parse_alias
    return parse_alias(read_lines(spark, path))


def cover_types(spark: SparkSession, path: str, numeric: int = 10, wild: int = 4,
                soil: int = 40) -> DataFrame:
    """Header-less numeric CSV: numeric columns, wilderness and soil one-hot
    flags, 1-based label last."""
    names = ([f"e{i}" for i in range(numeric)] + [f"w{i}" for i in range(wild)]
             + [f"s{i}" for i in range(soil)] + ["label"])
    schema = T.StructType([T.StructField(n, T.DoubleType()) for n in names])
    return read_csv(spark, path, schema, header=False)


def network_records(spark: SparkSession, path: str, n_features: int = 41,
                    categorical: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Header-less network-connection CSV: numeric features, three string
    features (protocol, service, flag by default), the label last."""
    fields = []
    for i in range(n_features):
        t = T.StringType() if i in categorical else T.DoubleType()
        fields.append(T.StructField(f"_c{i}", t))
    fields.append(T.StructField("label", T.StringType()))
    return read_csv(spark, path, T.StructType(fields), header=False)


def _row_id(*cols: str) -> F.Column:
    """A stable row id: a hash of the columns and of a number among equal rows."""
    equal = Window.partitionBy(F.xxhash64(*cols)).orderBy(*cols)
    return F.xxhash64(*cols, F.row_number().over(equal))


def articles(spark: SparkSession, path: str) -> DataFrame:
    """Multi-line JSON array of {title, text} -> (doc_id, title, text).  The
    id is a hash of file, title, text and, for equal articles, their number,
    so copies stay apart and every scan gives the same ids."""
    schema = T.StructType([T.StructField("title", T.StringType()), T.StructField("text", T.StringType())])
    df = spark.read.schema(schema).option("multiLine", True).json(path)
    df = df.select("title", "text", F.col("_metadata.file_path").alias("file"))
    return df.select(_row_id("file", "title", "text").alias("doc_id"), "title", "text")


def citation_topics(spark: SparkSession, path: str, row_tag: str = "MedlineCitation") -> DataFrame:
    """Citation XML (gzip read transparently), one row per citation; output
    (citation, topic) for every major-topic descriptor name."""
    name = T.StructType([T.StructField("_VALUE", T.StringType()),
                         T.StructField("_MajorTopicYN", T.StringType())])
    heading = T.StructType([T.StructField("DescriptorName", name)])
    hlist = T.StructType([T.StructField("MeshHeading", T.ArrayType(heading))])
    schema = T.StructType([T.StructField("PMID", T.StringType()),
                           T.StructField("MeshHeadingList", hlist)])
    from quarry.operators.cooccur import major_topics
    c = spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)
    return major_topics(c.withColumn("PMID", F.coalesce("PMID", F.monotonically_increasing_id().cast("string"))))


# Fixed values (see the note at the top): taxi CSV columns in file order.
TAXI_COLUMNS = ("medallion", "hack_license", "vendor_id", "rate_code", "store_and_fwd_flag",
                "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_time_in_secs",
                "trip_distance", "pickup_longitude", "pickup_latitude", "dropoff_longitude",
                "dropoff_latitude")


def taxi_trips(spark: SparkSession, path: str) -> DataFrame:
    """Trip CSV with a header (read as strings, parsed by
    ``trips.parse_trips``); license = hack license; a trip id is added, the same
    in every scan of the file."""
    raw = read_csv(spark, path, string_schema(*TAXI_COLUMNS), header=True)
    return raw.select(_row_id(*TAXI_COLUMNS).alias("trip_id"),
                      F.col("hack_license").alias("license"),
                      "pickup_datetime", "dropoff_datetime", "pickup_longitude", "pickup_latitude",
                      "dropoff_longitude", "dropoff_latitude")


def geojson_zones(spark: SparkSession, path: str, code: str = "boroughCode",
                  name: str = "borough") -> DataFrame:
    """GeoJSON FeatureCollection of Polygons and MultiPolygons -> (zone_code,
    zone, rings, area): ``rings`` are all rings of all parts, holes included;
    the area is that of the outer rings less the holes.  Features of other
    kinds are left out."""
    geom = T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])
    props = T.StructType([T.StructField(code, T.StringType()), T.StructField(name, T.StringType())])
    feat = T.StructType([T.StructField("properties", props), T.StructField("geometry", geom)])
    schema = T.StructType([T.StructField("features", T.ArrayType(feat))])
    f = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    text = F.col("f.geometry.coordinates")
    parts = (F.when(F.col("f.geometry.type") == "Polygon", F.array(F.from_json(text, "array<array<array<double>>>")))
             .when(F.col("f.geometry.type") == "MultiPolygon", F.from_json(text, "array<array<array<array<double>>>>")))
    parts = F.transform(parts, lambda rings: F.transform(rings, lambda ring: F.transform(
        ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))))
    f = f.select(F.col(f"f.properties.{code}").try_cast("int").alias("zone_code"),
                 F.col(f"f.properties.{name}").alias("zone"), parts.alias("parts")).where("parts is not null")

    def own(rings):
        return F.aggregate(F.transform(rings, lambda ring, i: F.when(i == 0, polygon_area(ring)).otherwise(-polygon_area(ring))),
                           F.lit(0.0), lambda s, x: s + x)
    area = F.aggregate(F.transform("parts", own), F.lit(0.0), lambda s, x: s + x)
    return f.select("zone_code", "zone", F.flatten("parts").alias("rings"), area.alias("area"))


def price_folder(spark: SparkSession, path: str, date_format: str = "dd-MMM-yy", folders: bool = False) -> DataFrame:
    """A folder of per-instrument CSVs (header, newest first, possibly with a
    byte-order mark): instrument = file name without extension, date parsed
    as ``date_format``, price = the first value column; unparsable rows dropped.
    With ``folders`` an instrument has a folder ``instrument=<name>`` of any
    number of files.  Order is irrelevant here: the calendar fill orders by
    date."""
    raw = read_csv(spark, path, string_schema("date", "open"), header=True)
    fname = F.col("instrument") if folders else F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1)
    date = F.try_to_timestamp(F.regexp_replace("date", "^﻿", ""), F.lit(date_format))
    return (raw.select(fname.alias("instrument"), F.to_date(date).alias("date"),
                       F.col("open").try_cast("double").alias("price"))
            .where(F.col("date").isNotNull() & F.col("price").isNotNull()))


def image_folders(spark: SparkSession, path: str, label_of: dict[str, int]) -> DataFrame:
    """binaryFile scan of class folders (path/<class>/...): path, bytes and
    the literal label of the folder."""
    b = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    folder = F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1)
    lab = F.lit(None).cast("int")
    for k, v in label_of.items():
        lab = F.when(folder == k, F.lit(v)).otherwise(lab)
    return b.select("path", "content", "length", lab.alias("label")).where(F.col("label").isNotNull())
