"""Deterministic sharded WARC writer and reader.

Records are range-partitioned and sorted by page id, each task writes one gzip
member per record and rolls to a new file by compressed size.  A file is
written under a temporary name and renamed when complete; the list of files
with record counts, sizes and digests is the manifest, itself committed last
(temporary name, then rename).  Readers follow the manifest only, so files of
lost or repeated attempts are never read.  Shard bounds, record ids, dates and
gzip headers depend on the records alone: a rerun writes the same bytes.

Of records with equal payloads of at least ``min_bytes`` the one with the
smallest page id is the response, the others revisit it; of repeated rows of
that page the first is the response.

Defined results: null html is an empty payload; a null url becomes an empty
target; null page ids come first, dealt over shards of their own by payload
digest, are written with an empty id, and are the smallest only where no other id has the payload; an empty table writes an
empty manifest; other columns are never read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import written
from quarry.operators.recommend import item_index
from quarry.session import shared_dir

DATE = "2000-01-01T00:00:00Z"  # fixed: headers are regenerated, not dated
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

MANIFEST = "file string, records long, bytes long, sha256 string"
PAGES = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
         "refers_to long, payload binary")


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder's full address: a path without a scheme lies on Hadoop's
    default file system, as Spark's own readers have it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    full = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return full.replace("file:/", "file:///", 1) if not full.startswith("file:///") else full


def _open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder on any storage that Arrow knows."""
    return fs.FileSystem.from_uri(uri)


def record_bytes(page_id, url, payload: bytes, digest: bytes, refers_to, serial: int) -> bytes:
    """One WARC/1.1 record.  ``serial`` tells repeated rows of a page apart,
    and rows of one payload where the page id is null."""
    sha = "sha256:" + base64.b32encode(digest).decode()
    name = lambda i, n: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{i}:{n}')}>"
    kind = "response" if refers_to is None else "revisit"
    block = (HTTP % len(payload)) + (payload if kind == "response" else b"")
    head = [("WARC-Type", kind), ("WARC-Record-ID", name(digest.hex() if page_id is None else page_id, serial)), ("WARC-Date", DATE),
            ("WARC-Target-URI", (url or "").replace("\r", "%0D").replace("\n", "%0A")),
            ("WARC-Payload-Digest", sha),
            ("WARC-Block-Digest", "sha256:" + base64.b32encode(hashlib.sha256(block).digest()).decode()),
            ("X-Page-ID", "" if page_id is None else str(page_id)), ("X-Payload-Length", str(len(payload)))]
    if kind == "revisit":
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", name(refers_to, 0)), ("X-Refers-To-Page", str(refers_to))]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return text.encode() + block + b"\r\n\r\n"


class _Roller:
    """Writes members to numbered files of about ``limit`` compressed bytes."""

    def __init__(self, folder: str, limit: int):
        self.fs, self.path = _open_fs(folder)
        self.limit, self.out, self.done = limit, None, []

    def add(self, shard: int, member: bytes) -> None:
        if self.out is not None and (shard != self.shard or self.size + len(member) > self.limit):
            self.close()
        if self.out is None:
            if not self.done or self.shard != shard:
                self.shard, self.seq = shard, 0
            self.name = f"part-{shard:06d}-{self.seq:05d}.warc.gz"
            self.seq += 1
            self.tmp = f"{self.path}/_tmp-{uuid.uuid4().hex}-{self.name}"
            self.out = self.fs.open_output_stream(self.tmp, compression=None)
            self.size, self.count, self.sha = 0, 0, hashlib.sha256()
        self.out.write(member)
        self.sha.update(member)
        self.size += len(member)
        self.count += 1

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.fs.move(self.tmp, f"{self.path}/{self.name}")
            self.done.append((self.name, self.count, self.size, self.sha.hexdigest()))
            self.out = None


def _write_task(folder: str, roll_bytes: int, min_bytes: int):
    """Rows sorted by (shard, page, digest, kind): a decision row (kind 0)
    stands before the payload rows (kind 1) that it is about."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll = _Roller(folder, roll_bytes)
        last, refers, serial, page, seen = None, None, 0, object(), False
        for batch in batches:
            for r in batch.to_pylist():
                key = (r["page_id"], r["digest"])
                if r["page_id"] != page:
                    page, serial = r["page_id"], 0
                if key != last:
                    last, refers, seen = key, None, False
                    if page is None:
                        serial = 0
                if r["kind"] == 0:
                    refers = r["refers_to"]
                    continue
                payload = r["payload"] or b""
                ref = refers
                if seen and ref is None and len(payload) >= min_bytes and r["page_id"] is not None:
                    ref = r["page_id"]  # a repeated row of the response's own page
                seen = True
                raw = record_bytes(r["page_id"], r["url"], payload, r["digest"], ref, serial)
                serial += 1
                roll.add(r["shard"], gzip.compress(raw, 6, mtime=0))
        roll.close()
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("file", "records", "bytes", "sha256"), x)) for x in roll.done],
            schema=pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()),
                              ("sha256", pa.string())]))
    return run


def shard_bounds(ids: DataFrame, per_shard: int, fine: int = 16) -> list[int]:
    """Upper bounds of the shards: about every ``per_shard``-th id in id order,
    from marks, the ids whose hash is a multiple of a step that leaves ``fine``
    marks a shard at any size.  The marks are sorted and numbered on the
    cluster; the driver gets one number a shard.  They depend on the ids alone
    (no sampling seed) and only place bounds; every row is written."""
    step = max(1, per_shard // fine)
    every = max(1, per_shard // step)
    marks = ids.where(F.col("page_id").isNotNull() & (F.pmod(F.xxhash64("page_id"), F.lit(step)) == 0))
    kept = item_index(marks.select(F.col("page_id").alias("item")))
    kept = kept.where((F.col("idx") > 0) & (F.col("idx") % every == 0)).select("item").toArrow()
    return sorted(kept.column("item").to_pylist())


def _with_shard(rows: DataFrame, bounds: list[int], null_shards: int) -> DataFrame:
    """``shard``: null ids are dealt over the first ``null_shards`` by their
    payload's digest; then the number of bounds at or below the page id."""
    spread = F.pmod(F.xxhash64("digest"), F.lit(null_shards))
    if not bounds:
        return rows.withColumn("shard", F.when(F.col("page_id").isNull(), spread).otherwise(null_shards).cast("int"))
    inf = float("inf")
    cut = Bucketizer(splits=[-inf, *sorted(set(map(float, bounds))), inf], inputCol="_id", outputCol="_shard")
    return (cut.transform(rows.withColumn("_id", F.coalesce(F.col("page_id").cast("double"), F.lit(-inf))))
            .withColumn("shard", F.when(F.col("page_id").isNull(), spread)
                        .otherwise(F.col("_shard") + null_shards).cast("int")).drop("_id", "_shard"))


def write_archive(pages: DataFrame, folder: str, min_bytes: int = 100, roll_bytes: int = 64 << 20,
                  per_shard: int = 5_000) -> str:
    """Pages (page_id, url, html) -> WARC files and ``manifest.json`` in ``folder``."""
    spark = pages.sparkSession
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                     F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    p = p.withColumn("digest", F.unhex(F.sha2("payload", 256)))
    ids = written(p.select("page_id", "digest", F.length("payload").alias("n")), "warc-ids")
    # decisions: partial minima per digest before the shuffle; only repeated digests are joined
    same = (ids.where(F.col("n") >= min_bytes).groupBy("digest")
            .agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("c")).where("c > 1"))
    told = (ids.where(F.col("n") >= min_bytes).join(same, "digest")
            .where("page_id is null or page_id > refers_to").where("refers_to is not null")
            .select("page_id", "digest", "refers_to").distinct())
    bounds = shard_bounds(ids, per_shard)
    null_shards = max(1, -(-ids.where("page_id is null").count() // per_shard))
    rows = (p.select("page_id", "digest", F.lit(1).alias("kind"), "url", "payload",
                     F.lit(None).cast("long").alias("refers_to"))
            .unionByName(told.select("page_id", "digest", F.lit(0).alias("kind"),
                                     F.lit(None).cast("string").alias("url"),
                                     F.lit(None).cast("binary").alias("payload"), "refers_to")))
    rows = _with_shard(rows, bounds, null_shards)
    folder = _qualified(spark, folder)
    files, path = _open_fs(folder)
    files.create_dir(path, recursive=True)
    parts = (rows.repartitionById(null_shards + len(bounds) + 1, F.col("shard"))  # a task a shard
             .sortWithinPartitions("shard", "page_id", "digest", "kind", "url")
             .mapInArrow(_write_task(folder, roll_bytes, min_bytes), MANIFEST))
    parts = sorted(map(tuple, written(parts, "warc-parts").collect()))
    tmp = f"{path}/_tmp-{uuid.uuid4().hex}-manifest.json"
    with files.open_output_stream(tmp) as out:
        out.write(json.dumps([dict(zip(("file", "records", "bytes", "sha256"), x)) for x in parts]).encode())
    files.move(tmp, f"{path}/manifest.json")
    return folder


def _members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a stream, decompressed one by one."""
    z, parts, data = zlib.decompressobj(31), [], stream.read(chunk)
    while data:
        parts.append(z.decompress(data))
        data = z.unused_data if z.eof else b""
        if z.eof:
            yield b"".join(parts)
            z, parts = zlib.decompressobj(31), []
        if not data:
            data = stream.read(chunk)
    if parts:
        raise ValueError("the file ends inside a record")


def parse_record(raw: bytes) -> dict:
    """A record's fields and payload; digests and lengths are checked."""
    head, block = raw.split(b"\r\n\r\n", 1)
    lines = head.decode().split("\r\n")
    field = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = block[:int(field["Content-Length"])]
    want = field["WARC-Block-Digest"].removeprefix("sha256:")
    if base64.b32encode(hashlib.sha256(block).digest()).decode() != want:
        raise ValueError("block digest differs")
    payload = block.split(b"\r\n\r\n", 1)[1]
    digest = base64.b32decode(field["WARC-Payload-Digest"].removeprefix("sha256:"))
    kind = field["WARC-Type"]
    if kind == "response" and hashlib.sha256(payload).digest() != digest:
        raise ValueError("payload digest differs")
    whole = lambda k: int(field[k]) if field.get(k) else None
    return {"page_id": whole("X-Page-ID"), "url": field["WARC-Target-URI"],
            "payload_bytes": int(field["X-Payload-Length"]), "payload_digest": digest.hex(), "record_type": kind,
            "refers_to": whole("X-Refers-To-Page"), "payload": payload if kind == "response" else None}


def _read_task(folder: str, batch_bytes: int = 8 << 20):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _open_fs(folder)
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                            ("payload_digest", pa.string()), ("record_type", pa.string()),
                            ("refers_to", pa.int64()), ("payload", pa.binary())])
        for batch in batches:
            for f in batch.to_pylist():
                rows, held, n = [], 0, 0
                with files.open_input_stream(f"{path}/{f['file']}", compression=None) as stream:
                    for raw in _members(stream):
                        rows.append(parse_record(raw))
                        held, n = held + len(raw), n + 1
                        if held >= batch_bytes:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                if n != f["records"]:
                    raise ValueError(f"{f['file']}: {n} records, the manifest has {f['records']}")
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return run


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the files in the manifest; a revisit has no
    payload of its own, its length and digest are those of the full payload."""
    folder = _qualified(spark, folder)
    files, path = _open_fs(folder)
    with files.open_input_stream(f"{path}/manifest.json") as f:
        parts = json.loads(f.read())
    rows = [(x["file"], x["records"], x["bytes"], x["sha256"]) for x in parts]
    listed = spark.createDataFrame(rows, MANIFEST)
    return listed.repartition(max(1, len(rows)), "file").mapInArrow(_read_task(folder), PAGES)


def round_trip(pages: DataFrame, **how) -> DataFrame:
    """Write ``pages`` as an archive in the shared folder and read it back."""
    spark = pages.sparkSession
    folder = write_archive(pages, shared_dir(spark, "warc"), **how)
    return read_archive(spark, folder)
