"""General table queries: sources and sinks, SQL views, sampling, summaries, set ops."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import basic
from quarry.plans.queries.graph import components
from quarry.plans.queries.trips import _trips_done
from quarry.plans.registry import query, r4
from quarry.session import shared_dir
from quarry.sources import files, results
from quarry.sources.tables import table


@query("csv_roundtrip")
def csv_roundtrip(spark, d):
    """Compute-or-load: parts written as CSV with a header and read back with
    an explicit schema (the reload keeps the types)."""
    p = table(spark, d, "part")
    path = files.write_csv(p, shared_dir(spark, "part-csv"))
    return files.read_csv(spark, path, p.schema, header=True)


@query("materialized_components")
def materialized_components(spark, d):
    """Components computed once into Parquet in the shared folder, then loaded
    as long as the input files stay as they were."""
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("component", T.LongType())])
    inputs = [f"{d.rstrip('/')}/{t}.parquet" for t in ("lineitem", "supplier")]
    return results.compute_or_load(spark, "components", inputs, schema, lambda: components(spark, d))


@query("view_sql")
def view_sql(spark, d):
    """SQL over temp views: part-type frequency table, ordered by count."""
    table(spark, d, "lineitem", "l_partkey").createOrReplaceTempView("q_lineitem")
    table(spark, d, "part", "p_partkey", "p_type").createOrReplaceTempView("q_part")
    return spark.sql("""
        SELECT p_type, count(*) AS cnt FROM q_lineitem JOIN q_part ON l_partkey = p_partkey
        GROUP BY p_type ORDER BY cnt DESC""")


@query("flatten")
def flatten(spark, d):
    p = table(spark, d, "part", "p_partkey", "p_name")
    return basic.flatten(p, ["p_partkey"], F.split("p_name", " ")).withColumnRenamed("element", "word")


@query("sample_hash")
def sample_hash(spark, d):
    """5 % Bernoulli sample of order lines (hash of order, line, part)."""
    li = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return basic.hash_sample(li, 0.05, 1, "l_orderkey", "l_linenumber", "l_partkey")


@query("sample_stats")
def sample_stats(spark, d):
    """Per return flag: summary of the discount-adjusted price, NULL when the
    discount is zero (counted as missing), plus abs / pow / sqrt / ceil."""
    li = table(spark, d, "lineitem", "l_returnflag", "l_extendedprice", "l_discount")
    v = F.when(F.col("l_discount") > 0, F.col("l_extendedprice") * (1 - F.col("l_discount")))
    s = basic.summary(li.withColumn("v", v), "v", ["l_returnflag"])
    return s.select("l_returnflag", "cnt", "missing", r4("mean").alias("mean"), r4("stdev").alias("stdev"),
                    r4("min").alias("min"), r4("max").alias("max"),
                    F.ceil(F.sqrt(F.abs(F.col("max") - F.col("min")))).alias("ceil_sqrt_range"),
                    r4(F.pow(F.col("mean") / 1000.0, 2)).alias("mean_k_sq"))


@query("top_k")
def top_k(spark, d):
    """Ten largest orders by total price (ties by key)."""
    o = table(spark, d, "orders", "o_orderkey", "o_totalprice")
    return basic.top_k(o, 10, F.col("o_totalprice").desc(), F.col("o_orderkey").asc())


@query("sorted_summary")
def sorted_summary(spark, d):
    """Customers per nation with their share, sorted by count descending."""
    c = table(spark, d, "customer", "c_nationkey")
    n = c.select(F.count(F.lit(1)).cast("double")).scalar()
    return (c.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("cnt"))
            .withColumn("share", F.round(F.col("cnt") / n, 6))
            .orderBy(F.col("cnt").desc(), "c_nationkey"))


@query("union_distinct")
def union_distinct(spark, d):
    """Suppliers that ship anything, union suppliers in debt, distinct."""
    a = table(spark, d, "lineitem", "l_suppkey").select(F.col("l_suppkey").alias("suppkey"))
    b = table(spark, d, "supplier", "s_suppkey", "s_acctbal").where(F.col("s_acctbal") < 0) \
        .select(F.col("s_suppkey").alias("suppkey"))
    return basic.union_distinct(a, b)


@query("partition_pairs")
def partition_pairs(spark, d):
    """Consecutive trips per license by repartition + sortWithinPartitions +
    mapInPandas (the explicit co-locate-and-sort form of next_trip)."""
    t = _trips_done(spark, d)
    p = basic.consecutive_pairs(t, "license", ["pickup_datetime", "trip_id"], "trip_id",
                                ["pickup_datetime"],
                                "license string, trip_id long, next_trip_id long, "
                                "pickup_datetime timestamp_ntz, next_pickup_datetime timestamp_ntz")
    return p.select("license", "trip_id", "next_trip_id")
