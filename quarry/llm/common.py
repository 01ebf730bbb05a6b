"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import last_use, shared_dir

#: largest side that may be broadcast, in bytes as counted by ``small_enough``
BROADCAST_BYTES = 64 << 20


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the cluster's shared folder and read it
    back: lineage is cut and a lost executor loses nothing.  The write is a
    fresh folder each time."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    last_use(df, lambda x: x.write.parquet(path, compression=compression))
    return spark.read.schema(df.schema).parquet(path)


def small_enough(df: DataFrame, width: int, limit: int = BROADCAST_BYTES) -> bool:
    """True when ``df`` (cheap to scan: a written table) has at most
    ``limit`` bytes at ``width`` bytes a row."""
    return df.limit(limit // width + 1).count() * width <= limit


def bounded(df: DataFrame, width: int) -> DataFrame:
    """``df`` with a broadcast hint when its checked size allows one; else
    unchanged, so that the join shuffles."""
    return F.broadcast(df) if small_enough(df, width) else df


def sized(df: DataFrame, array: str, item: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Like ``bounded`` for rows that hold an array of ``item`` bytes each."""
    n, m = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size(array)), F.lit(0))).first()
    return F.broadcast(df) if 64 * n + item * m <= limit else df


def spread_join(left: DataFrame, right: DataFrame, *on: str, most: int = 20_000) -> DataFrame:
    """``left`` left-joined with ``right``, whose keys ``on`` are unique, when a
    key may hold a third of ``left`` (a written table).

    A key of more than max(most, rows / 100,000) rows is dealt by a hash of
    the whole row over as many shares as keep each below that; the row of
    ``right`` is repeated for each share.  There are fewer than 100,000 such
    keys whatever the size of ``left``, so their list may be broadcast.
    """
    top = max(most, left.count() // 100_000)
    hot = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > top)
    hot = written(hot.select(*on, F.ceil(F.col("_n") / top).cast("int").alias("_shares")), "hot-keys")
    if hot.limit(1).count() == 0:
        return left.join(right, list(on), "left")
    keys = F.broadcast(hot)
    share = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.coalesce("_shares", F.lit(1))).cast("int")
    dealt = left.join(keys, list(on), "left").withColumn("_share", share).drop("_shares")
    copies = right.join(keys, list(on), "left").withColumn(
        "_share", F.explode(F.sequence(F.lit(0), F.coalesce("_shares", F.lit(1)) - 1))).drop("_shares")
    return dealt.join(copies, [*on, "_share"], "left").drop("_share")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only (``lower`` would also change other scripts)."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_fold(doc_id: Column, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod``; a null id is fold -1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod, F.lit(-1))


def labelled(docs: DataFrame, labels: DataFrame, what: str, mod: int, held: int, most: int) -> DataFrame:
    """(doc_id, text, label, pick) of at most ``most`` labelled documents
    outside the held-out fold, in the order of a hash of the id, so the sample
    is the same in every run.  ``pick`` (0..99) deals them out.  A doc_id with
    several labels takes the commoner one (1 on a tie); null ids and labels
    other than 0 and 1 are left out."""
    lab = (labels.where(F.col(what).isin(0, 1) & F.col("doc_id").isNotNull() & (crc_fold(F.col("doc_id"), mod) != held))
           .groupBy("doc_id").agg((F.avg(what) >= 0.5).cast("int").alias("label"))
           .withColumn("_o", F.xxhash64("doc_id")).orderBy("_o", "doc_id").limit(most))
    lab = written(lab.select("doc_id", "label", F.pmod("_o", F.lit(100)).alias("pick")), "labelled")
    return docs.select("doc_id", "text").join(bounded(lab, 32), "doc_id")


def isotonic(points: DataFrame) -> tuple[list[float], list[float]]:
    """(x, label) -> the steps of a rising fit of label on x, for
    interpolation.  Without points of both labels: their common label."""
    seen = [r[0] for r in points.select("label").distinct().collect()]
    if len(seen) < 2:
        return [0.0], [float(seen[0]) if seen else 0.0]
    fit = IsotonicRegression(featuresCol="x", labelCol="label").fit(
        points.select(F.col("x").cast("double"), F.col("label").cast("double")))
    return [float(v) for v in fit.boundaries.toArray()], [float(v) for v in fit.predictions.toArray()]
