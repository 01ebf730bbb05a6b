"""Archives of many shards and files, repeated tasks, and records whose ids are null."""
import hashlib
import json
import os
import tempfile
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from quarry.llm import warc


def pages(spark):
    rows = [(i, f"http://h/{i}", ("page %d " % (i % 70)) * 30) for i in range(300)]
    rows += [(None, "http://n/", ("null %d " % (i % 15)) * 20) for i in range(45)]
    rows += [(7, "http://again/", "seven " * 40), (7, "http://again/", "seven " * 40), (301, None, None), (302, "u", "")]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)


def expect(rows):
    least = {}
    for i, _, t in rows:
        if i is not None:
            d = hashlib.sha256((t or "").encode()).hexdigest()
            least[d] = min(i, least.get(d, i))
    out, first = Counter(), set()
    for i, _, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        b = (t or "").encode()
        d = hashlib.sha256(b).hexdigest()
        ref = None
        if len(b) >= 100 and d in least:
            if i != least[d] or (i, d) in first:
                ref = least[d]
            first.add((i, d))
        out[(i, len(b), d, "response" if ref is None else "revisit", ref)] += 1
    return out


def listing(folder):
    with open(os.path.join(folder, "manifest.json")) as f:
        return json.load(f)


def got(spark, folder):
    back = warc.read_archive(spark, folder)
    return Counter(map(tuple, back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()))


def test_many_shards_and_rolled_files(spark):
    rows, df = pages(spark)
    folder = tempfile.mkdtemp(prefix="warc-")
    warc.write_archive(df, folder, roll_bytes=2000, per_shard=10)
    parts = listing(folder)
    shards = {p["file"].split("-")[1] for p in parts}
    assert len(shards) > 20 and max(int(p["file"].split("-")[2].split(".")[0]) for p in parts) > 0
    assert all(p["bytes"] <= 2000 or p["records"] == 1 for p in parts)
    assert sum(p["records"] for p in parts) == len(rows)
    for p in parts:
        with open(os.path.join(folder, p["file"]), "rb") as f:
            assert hashlib.sha256(f.read()).hexdigest() == p["sha256"]
    assert not [x for x in os.listdir(folder) if x.startswith("_tmp")]
    assert got(spark, folder) == expect(rows)
    # page ids rise from shard to shard, and null ids lie in several shards of their own
    ranges = {}
    for p in parts:
        with open(os.path.join(folder, p["file"]), "rb") as f:
            for raw in warc._members(f):
                ranges.setdefault(p["file"].split("-")[1], []).append(warc.parse_record(raw)["page_id"])
    nulls = [s for s, ids in ranges.items() if None in ids]
    assert len(nulls) > 1 and all(set(ranges[s]) == {None} for s in nulls)
    ordered = [i for s in sorted(ranges) if s not in nulls for i in ranges[s]]
    assert ordered == sorted(ordered)


def test_reruns_write_the_same_bytes_and_record_ids_differ(spark):
    rows, df = pages(spark)
    a, b = (warc.write_archive(x, tempfile.mkdtemp(prefix="warc-"), roll_bytes=3000, per_shard=40)
            for x in (df, df.repartition(2, F.rand(3))))
    local = [x.replace("file://", "") for x in (a, b)]
    assert listing(local[0]) == listing(local[1])
    names = []
    for p in listing(local[0]):
        with open(os.path.join(local[0], p["file"]), "rb") as f:
            names += [raw.split(b"WARC-Record-ID: ")[1].split(b"\r\n")[0] for raw in warc._members(f)]
    assert len(names) == len(set(names)) == len(rows)


def test_a_lost_and_a_repeated_task_leave_a_whole_archive(spark):
    rows, df = pages(spark)
    folder = warc.write_archive(df, tempfile.mkdtemp(prefix="warc-"), roll_bytes=2000, per_shard=30)
    path = folder.replace("file://", "")
    before = listing(path)
    batch = pa.RecordBatch.from_pylist([
        {"page_id": 1, "digest": hashlib.sha256(b"x" * 200).digest(), "kind": 1, "url": "u", "payload": b"x" * 200,
         "refers_to": None, "shard": 900}])

    def lost():
        yield batch
        raise RuntimeError("executor lost")
    try:
        list(warc._write_task(folder, 2000, 100)(lost()))
    except RuntimeError:
        pass
    list(warc._write_task(folder, 2000, 100)(iter([batch])))      # an attempt whose result nobody took
    assert len(os.listdir(path)) > len(before) + 1 and listing(path) == before
    assert got(spark, folder) == expect(rows)
