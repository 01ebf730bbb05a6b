"""Session construction and the shared scratch / checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "quarry", extra: dict | None = None) -> SparkSession:
    """A session for tests and the bench.  On a cluster the caller's session
    (with its own ``spark.checkpoint.dir``) is used instead."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("QUARRY_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def _checkpoint_root(spark: SparkSession) -> str | None:
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if d:
        return d
    try:
        d = spark.conf.get("spark.checkpoint.dir")
    except Exception:  # noqa: BLE001 - unset key raises on some versions
        d = None
    if d:
        return d
    return sc.getCheckpointDir()


def shared_dir(spark: SparkSession, sub: str | None = None) -> str:
    """Folder every executor can read and write.

    It is the cluster's ``spark.checkpoint.dir`` (read from the session).
    Only when that is unset *and* the master is local (tests, the bench) do we
    pick our own folder and register it as the checkpoint dir.  ``sub`` gives
    a fresh, uniquely named child for one job's written tables.
    """
    root = _checkpoint_root(spark)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is unset: point it at a folder shared by "
                "all executors (HDFS/S3/ABFS) before running quarry jobs")
        root = tempfile.mkdtemp(prefix="quarry-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    if sub is None:
        return root
    return root.rstrip("/") + f"/quarry-{sub}-{uuid.uuid4().hex[:12]}"


#: Spark's switch for removing a query's shuffle files when it has ended
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Frames and writes made inside have their shuffle files removed when they end."""
    before = spark.conf.get(CLEAN_SHUFFLES, None)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEAN_SHUFFLES)
        else:
            spark.conf.set(CLEAN_SHUFFLES, before)


def last_use(df: DataFrame, action):
    """``action`` (a write or a checkpoint) on ``df``, whose shuffle files are removed
    when it ends, not when the driver's garbage collection gets to them."""
    with shuffles_removed(df.sparkSession):
        return action(df.select("*"))   # frames and writes take the setting when they are made


def handed_off(df: DataFrame, name: str):
    """``df`` written as Parquet to the shared folder and read back, and a function
    that removes the files, for when nothing reads them any more."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    last_use(df, lambda x: x.write.parquet(path))

    def remove() -> None:
        hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hp, True)
    return spark.read.schema(df.schema).parquet(path), remove


def even_keys(spark: SparkSession, parts: int, least: int) -> list[int]:
    """At least ``least`` ints that a shuffle by an int column deals evenly over ``parts`` partitions."""
    from pyspark.sql import functions as F
    rows = spark.range(8 * (parts + least)).select(F.col("id").cast("int").alias("id"))
    dealt: dict[int, list[int]] = {}
    for r in rows.select("id", F.pmod(F.hash("id"), F.lit(parts)).alias("p")).collect():   # numbers only
        dealt.setdefault(r["p"], []).append(r["id"])
    turn = max(len(x) for x in dealt.values())
    return [x[i] for i in range(turn) for _, x in sorted(dealt.items()) if i < len(x)]


_SOURCES: dict[tuple, str] = {}


def stand_in_source(spark: SparkSession, name: str, key: str, write) -> str:
    """Path of a stand-in input file set (e.g. the trip CSV made from events),
    written once per Spark application and fixture and reused by every query
    that reads it, as real inputs would be.  ``write(path)`` creates it."""
    k = (spark.sparkContext.applicationId, name, key.rstrip("/"))
    path = _SOURCES.get(k)
    if path is not None:
        jvm = spark.sparkContext._jvm
        hp = jvm.org.apache.hadoop.fs.Path(path)
        if hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hp):
            return path
    path = shared_dir(spark, name)
    write(path)
    _SOURCES[k] = path
    return path
