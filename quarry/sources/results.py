"""Compute-or-load: result tables and models addressed by what they came from.

A result lives in ``<root>/<name>-<fingerprint>/<attempt>``.  The fingerprint
covers the input files (path, length, modification time), the result's schema
and the plan's parameters, so a changed input or parameter never meets an old
result.  An attempt counts once its marker exists, and the marker is written
last: what a lost driver left half-written is passed over.  Two writers of one
result each commit an attempt of their own, both whole and equal; readers take
the attempt of the smallest name.  Nothing is renamed or overwritten, so this
holds on object stores too.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import shared_dir

MARKER = "_COMMITTED-"


def results_root(spark: SparkSession) -> str:
    return shared_dir(spark).rstrip("/") + "/quarry-results"


def fingerprint(spark: SparkSession, inputs: Sequence[str], **params) -> str:
    """Hex digest of the files below ``inputs`` and of ``params`` (values that
    JSON can write).  Only the listing is read, as a table of its own, and
    added up by the executors; no file is opened."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(inputs))
             .select(F.xxhash64("path", "modificationTime", "length").alias("h")))
    seen = files.agg(F.count(F.lit(1)), F.bit_xor("h"), F.sum(F.col("h").cast("decimal(38,0)"))).first()
    said = json.dumps([[str(v) for v in seen], params], sort_keys=True)
    return hashlib.sha256(said.encode()).hexdigest()[:32]


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def committed(spark: SparkSession, home: str) -> str | None:
    """Path of the attempt that readers of ``home`` take, if there is one."""
    fs, pattern = _fs(spark, f"{home}/{MARKER}*")
    names = sorted(s.getPath().getName() for s in fs.globStatus(pattern) or [])
    return f"{home}/{names[0].removeprefix(MARKER)}" if names else None


def stored(spark: SparkSession, name: str, key: Callable[[], str], write: Callable[[str], None],
           root: str | None = None) -> str:
    """Path of the committed result ``name`` of the inputs that ``key()``
    fingerprints, written by ``write(path)`` if there is none.  Inputs that
    change while it is written give it another key: it is then left without a
    marker and made anew."""
    root = (root or results_root(spark)).rstrip("/")
    while True:
        now = key()
        home = f"{root}/{name}-{now}"
        at = committed(spark, home)
        if at is not None:
            return at
        attempt = uuid.uuid4().hex
        write(f"{home}/{attempt}")
        if key() == now:
            fs, marker = _fs(spark, f"{home}/{MARKER}{attempt}")
            fs.create(marker, False).close()


def compute_or_load(spark: SparkSession, name: str, inputs: Sequence[str], schema: T.StructType,
                    compute: Callable[[], DataFrame], root: str | None = None, **params) -> DataFrame:
    """The table that ``compute()`` makes of the files ``inputs`` under
    ``params``, from Parquet if an earlier call has committed it.  Columns are
    cast to ``schema`` before the write, so a load has the types of the first
    call."""
    def write(path: str) -> None:
        compute().select(*[F.col(f.name).cast(f.dataType) for f in schema]).write.parquet(path)
    path = stored(spark, name, lambda: fingerprint(spark, inputs, schema=schema.json(), **params), write, root)
    return spark.read.schema(schema).parquet(path)


def load_or_fit(spark: SparkSession, name: str, key: str, loader, fit: Callable[[], object],
                root: str | None = None):
    """The saved ML model ``name`` of the rows that ``key`` stands for, else
    fitted, saved and committed for the next run."""
    return loader.load(stored(spark, name, lambda: key, lambda path: fit().write().save(path), root))
