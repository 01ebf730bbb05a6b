"""Exact substring dedup with longest-previous-factor arrays.

A byte belongs to a repeat when a ``length``-byte string covering it also
starts elsewhere.  In suffix order, the nearest entries with a smaller text
position (previous and next smaller position) are a suffix's longest earlier
matches; their larger common prefix is its longest previous factor (LPF).
Starts with LPF >= ``length`` are later copies: removing what they cover keeps
the first copy (``keep="first"``).  With ``keep="none"`` starts that a later
start repeats go too.

The suffix array of a corpus does not fit a task, so it is built in parts that
hold every match:

1. The start of each ``length``-byte string is assigned to its minimiser, the
   least hashed k-gram among the first ``w`` of the string.  Consecutive
   starts with one minimiser form a run.  Equal strings have equal minimisers
   at equal offsets, and the ``length - w + 1`` bytes from there (the core)
   lie in every string of the run.
2. Runs whose core occurs once hold no repeat.  Runs equal over all their
   bytes are one class: every start of the later ones has its earlier match in
   the first.
3. Of cores with different classes, each class's first run is cut in slices of
   starts at like distance from the minimiser; only slices whose common bytes
   occur again go on.  They are laid out, in document order, in a buffer with
   the others of their key; the suffix order of the buffer's starts, compared
   to ``length`` bytes, is built by prefix doubling, whose steps also give the
   common prefixes of neighbours; previous and next smaller positions then give
   each start's LPF (and, seen from the end of the text, its longest later
   match), both counted to ``length``.
4. A key with more slices than ``wide`` is not laid out in one buffer: its
   starts are spread over the cluster by the hash of their strings, where the
   smallest start of each string is its earliest.

Document order is (doc_id, text hash, position); matches never cross
documents.

Defined results: null and empty texts have no bytes and lose none; a null
doc_id stands for itself and sorts first; rows equal in id and text repeat
each other (with ``keep="first"`` they count as one document, each kept); an
empty table gives no rows.  Other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import bytehash
from quarry.llm.common import bounded, sized, spread_join, written

#: starts handled at once in a long document; positions fit the low 20 bits
PIECE = 1 << 20
LOW = np.uint64(PIECE * 2 - 1)
#: starts of one slice of a run
SLICE = 32
#: bytes of slices laid out in one buffer for suffix sorting
BUFFER = 2 << 20


def window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every window of w values (two running minima per block)."""
    n = len(x)
    full = np.full(-(-n // w) * w, np.iinfo(x.dtype).max, dtype=x.dtype)
    full[:n] = x
    block = full.reshape(-1, w)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - w + 1], ahead[w - 1:n])


def runs(buf: np.ndarray, length: int, w: int, k: int):
    """Runs of starts of one document: (core, whole, first, last, anchor)
    arrays."""
    out = []
    for at in range(0, len(buf) - length + 1, PIECE):
        part = buf[at:at + PIECE + length - 1]
        starts = len(part) - length + 1
        r = bytehash.Ranges(part, 0)
        inv = bytehash.powers(r.base, len(part) + 1, True)
        m = starts + w - 1
        gram = bytehash.mix((r.sums[k:k + m] - r.sums[:m]) * inv[:m])
        anchor = (window_min((gram & ~LOW) | np.arange(m, dtype=np.uint64), w) & LOW).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1])
        last = np.append(first[1:] - 1, starts - 1)
        a = anchor[first]
        core = bytehash.Ranges(part, 1).hash(a, a + length - w + 1)
        out.append((core, r.hash(first, last + length), first + at, last + at, a + at))
    if not out:
        return None
    return [np.concatenate(x) for x in zip(*out)]


def _bytes(value) -> np.ndarray:
    return np.frombuffer((value.as_py() or "").encode("utf-8", "surrogatepass"), np.uint8)


RUN = "doc_id long, h long, core long, whole long, first int, last int, anchor int"


def _find_runs(length: int, w: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, cols = [], []
            for i, text in enumerate(batch.column(2)):
                got = runs(_bytes(text), length, w, k)
                if got is not None:
                    which.append(np.full(len(got[0]), i))
                    cols.append(got)
            if cols:
                core, whole, first, last, anchor = [np.concatenate(x) for x in zip(*cols)]
                at = pa.array(np.concatenate(which))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(core.view(np.int64)),
                     pa.array(whole.view(np.int64)), pa.array(first.astype(np.int32)),
                     pa.array(last.astype(np.int32)), pa.array(anchor.astype(np.int32))],
                    names=["doc_id", "h", "core", "whole", "first", "last", "anchor"])
    return run


def _cut_runs(length: int, slice_: int):
    """(doc_id, h, text, runs) -> runs cut in slices: starts whose distance to
    the run's minimiser lies between two multiples of ``slice_``, so that equal
    strings are in slices of one distance.  ``key`` is the hash of the bytes
    that all strings of such a slice hold, ``bytes`` what its strings cover."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, h, text, want in zip(*(batch.column(i).to_pylist() for i in range(4))):
                data = (text or "").encode("utf-8", "surrogatepass")
                for some in bytehash.pieces(want, lambda r: 4 * (r["last"] - r["first"] + length), 4 << 20):
                    near = np.array([r["anchor"] - r["last"] for r in some]) // slice_
                    n = np.array([r["anchor"] - r["first"] for r in some]) // slice_ - near + 1
                    who = np.repeat(np.arange(len(some)), n)
                    j = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + near[who]
                    anchor, lo, hi = (np.array([r[c] for r in some])[who] for c in ("anchor", "first", "last"))
                    core = np.array([r["core"] for r in some], np.int64)[who]
                    at = anchor - j * slice_
                    first, last = np.maximum(lo, at - slice_ + 1), np.minimum(hi, at)
                    base = int(first.min())
                    buf = np.frombuffer(data, np.uint8, int(last.max()) + length - base, base)
                    key = bytehash.Ranges(buf, 1).hash(at - base, at - base + length - slice_ + 1)
                    key = bytehash.mix(key ^ core.view(np.uint64) ^ j.astype(np.uint64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc] * len(who), pa.int64()), pa.array([h] * len(who), pa.int64()),
                         pa.array(key.view(np.int64)), pa.array(first.astype(np.int32)),
                         pa.array([data[a:b + length] for a, b in zip(first, last)], pa.binary())],
                        names=["doc_id", "h", "key", "first", "bytes"])
    return run


def suffix_order(buf: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, list]:
    """Ranks of the ``length``-byte strings at ``starts`` in lexicographic
    order (equal strings, equal rank), by prefix doubling, and the steps on the
    way: (bytes compared, rank of every position by them)."""
    n = len(buf)
    rank = np.zeros(n + length, dtype=np.uint64)  # past the end: zeros, never inside a start's string
    for i in range(min(8, length)):               # the first 8 bytes as one number
        rank[:n - i] |= buf[i:].astype(np.uint64) << np.uint64(8 * (7 - i))
    have = min(8, length)
    rank[:n] = np.unique(rank[:n], return_inverse=True)[1]
    steps = [(have, rank.astype(np.uint32))]
    while have < length:
        step = min(have, length - have)
        pair = (rank[:n] << np.uint64(32)) | rank[step:n + step]
        have += step
        if have == length:
            return np.unique(pair[starts], return_inverse=True)[1], steps
        rank[:n] = np.unique(pair, return_inverse=True)[1]
        steps.append((have, rank.astype(np.uint32)))
    return np.unique(rank[starts], return_inverse=True)[1], steps


def neighbour_lcp(buf: np.ndarray, at: np.ndarray, same: np.ndarray, steps: list, length: int) -> np.ndarray:
    """Common prefix, to ``length`` bytes, of each entry of suffix order (text
    positions ``at``) and the next: the doubling steps from the longest down,
    then single bytes."""
    a, b = at[:-1], at[1:]
    off = np.zeros(len(a), dtype=np.int64)
    last = len(steps[0][1]) - 1
    for have, rank in reversed(steps):
        off += np.where(rank[np.minimum(a + off, last)] == rank[np.minimum(b + off, last)], have, 0)
    more, end = np.ones(len(a), bool), len(buf) - 1
    for _ in range(7):
        more &= buf[np.minimum(a + off, end)] == buf[np.minimum(b + off, end)]
        off += more
    return np.where(same, length, np.minimum(off, length - 1))


def _to_smaller(key: np.ndarray, lcp: np.ndarray, most: int) -> np.ndarray:
    """For each entry, the common prefix with the previous entry of a smaller
    key (0 if there is none): windows of 2^l entries before it whose minimum
    is not smaller are passed over, the widest first, and the least LCP over
    what is passed is carried along."""
    m = len(key)
    low, reach = [key], [lcp]                     # minima of windows of 1, 2, 4, .. entries and their LCPs
    while 2 << (len(low) - 1) <= m:
        w = 1 << (len(low) - 1)
        low.append(np.minimum(low[-1][:-w], low[-1][w:]))
        reach.append(np.minimum(reach[-1][:len(reach[-1]) - w], reach[-1][w:]))
    cur = np.arange(m)
    got = np.full(m, most, dtype=np.int64)
    for level in range(len(low) - 1, -1, -1):
        j = cur - (1 << level)
        i = np.flatnonzero(j >= 0)
        i = i[low[level][j[i]] > key[i]]
        got[i] = np.minimum(got[i], reach[level][j[i]])
        cur[i] = j[i]
    first = cur == 0
    got[~first] = np.minimum(got[~first], lcp[cur[~first] - 1])
    got[first] = 0
    return got


def previous_factors(order: np.ndarray, lcp: np.ndarray, length: int, later: bool = False) -> np.ndarray:
    """LPF of each start (to ``length``): ``order`` lists the starts, numbered
    in text order, in suffix order, ``lcp`` the common prefix of neighbours.
    Among earlier starts the longest matches are the previous and the next
    smaller position in suffix order.  With ``later``, the longest match with a
    later start instead."""
    key = -order if later else order
    before = _to_smaller(key, lcp, length)
    after = _to_smaller(key[::-1], lcp[::-1], length)[::-1]
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.maximum(before, after)
    return out


def repeated_starts(buf: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For starts in text order: whether LPF >= length (an earlier match), and
    whether a later start matches as far."""
    rank, steps = suffix_order(buf, starts, length)
    order = np.argsort(rank, kind="stable")       # suffix order, ties by position
    same = rank[order[1:]] == rank[order[:-1]]
    lcp = neighbour_lcp(buf, starts[order], same, steps, length)
    return (previous_factors(order, lcp, length) >= length,
            previous_factors(order, lcp, length, later=True) >= length)


CUT = "doc_id long, h long, key long, first int, bytes binary"
FLAG = "doc_id long, h long, first int, last int"


def _spans_of(flag: np.ndarray, owner: np.ndarray, pos: np.ndarray):
    """Maximal runs of flagged consecutive positions of one owner."""
    i = np.flatnonzero(flag)
    if not len(i):
        return i, i
    cut = np.flatnonzero((np.diff(i) > 1) | (owner[i[1:]] != owner[i[:-1]]))
    a, b = i[np.append(0, cut + 1)], i[np.append(cut, len(i) - 1)]
    return a, b


def _sort_buffers(length: int, keep: str):
    """Slices sorted by (key, document order) -> flagged starts.  A buffer ends
    where a key ends."""
    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        col = rows.column("bytes")
        ends = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1]
        size = np.diff(ends)
        count = size - length + 1
        owner = np.repeat(np.arange(len(size)), count)
        inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        buf = np.frombuffer(col.buffers()[2], np.uint8)[ends[0]:ends[-1]]
        earlier, later = repeated_starts(buf, (ends[:-1] - ends[0])[owner] + inside, length)
        a, b = _spans_of(earlier if keep == "first" else earlier | later, owner, inside)
        lead = rows.column("first").to_numpy()
        who = pa.array(owner[a])
        return pa.RecordBatch.from_arrays(
            [rows.column("doc_id").take(who), rows.column("h").take(who),
             pa.array((lead[owner[a]] + inside[a]).astype(np.int32)), pa.array((lead[owner[b]] + inside[b]).astype(np.int32))],
            names=["doc_id", "h", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, key = [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("key").to_numpy()
            cuts = np.append(np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys))
            bytes_ = batch.column("bytes").nbytes / len(keys)
            at = 0
            for cut in [0, *cuts]:                # the rows before ``cut`` are whole keys, but perhaps the last
                if cut < len(keys) and keys[cut] != key and size + (cut - at) * bytes_ >= BUFFER:
                    if cut > at:
                        held.append(batch.slice(at, cut - at))
                    yield flush(held)
                    held, size, at = [], 0, cut
            held.append(batch.slice(at))
            size += (len(keys) - at) * bytes_
            key = keys[-1]
        if held:
            yield flush(held)
    return run


def _spread(length: int):
    """Slices of wide keys -> (key, string hash, doc_id, h, pos) of each start."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                buf = np.frombuffer(r["bytes"], np.uint8)
                p = np.arange(len(buf) - length + 1)
                f = bytehash.Ranges(buf, 0).hash(p, p + length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(p), r["key"])), pa.array(f.view(np.int64)),
                     pa.array([r["doc_id"]] * len(p), pa.int64()), pa.array(np.full(len(p), r["h"])),
                     pa.array((p + r["first"]).astype(np.int32))],
                    names=["key", "f", "doc_id", "h", "pos"])
    return run


def _place(pos: str = "first") -> Column:
    return F.struct("doc_id", "h", F.col(pos).alias("pos"))


def flagged_starts(docs: DataFrame, length: int, keep: str, w: int, k: int, wide: int) -> DataFrame:
    """Documents (doc_id, h, text) -> (doc_id, h, first, last): starts whose
    strings are to be removed, as ranges."""
    found = written(docs.mapInArrow(_find_runs(length, w, k), RUN), "runs")
    again = (found.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("core"))
    again = written(again.withColumn("again", F.lit(True)), "again")
    some = written(spread_join(found, again, "core").where("again").drop("again"), "repeated-cores")
    cls = (some.groupBy("core", "whole")
           .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(_place().alias("at"), "last", "anchor")).alias("one")))
    cls = written(cls.select("core", "whole", "n", "one.at", F.col("one.last").alias("end"), "one.anchor"), "classes")
    copies = spread_join(some, cls.where("n > 1").select("core", "whole", "at"), "core", "whole").where("at is not null")
    if keep == "first":
        copies = copies.where(~_place().eqNullSafe(F.col("at")))
    whole = copies.select("doc_id", "h", "first", "last")

    # cores with several classes: the first run of each class is compared with the others
    many = cls.groupBy("core").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("core")
    firsts = (cls.join(many, "core").groupBy(F.col("at.doc_id").alias("d"), F.col("at.h").alias("dh"))
              .agg(F.sort_array(F.collect_list(F.struct(F.col("at.pos").alias("first"), F.col("end").alias("last"),
                                                        "core", "anchor"))).alias("want")))
    firsts = sized(written(firsts, "first-runs"), "want", 24)
    texts = docs.join(firsts, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("dh")))
    cut = written(texts.select("doc_id", "h", "text", "want")
                  .mapInArrow(_cut_runs(length, min(SLICE, length)), CUT), "cut-runs")
    # a slice whose key no other class has holds no repeat; repeated rows of a document are one
    keys = (cut.select("key", "doc_id", "h", "first").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("m"))
            .where("m > 1").select("key", (F.col("m") > wide).alias("wide")))
    cut = written(cut.join(bounded(written(keys, "slice-keys"), 32), "key").dropDuplicates(["key", "doc_id", "h", "first"]),
                  "near-slices")
    near = (cut.where("not wide").repartition("key").sortWithinPartitions("key", "doc_id", "h", "first")
            .mapInArrow(_sort_buffers(length, keep), FLAG))
    spread = cut.where("wide").mapInArrow(_spread(length), "key long, f long, doc_id long, h long, pos int")
    ends = (spread.groupBy("key", "f").agg(F.min(_place("pos")).alias("lo"), F.max(_place("pos")).alias("hi"))
            .where("lo <> hi").select("key", "f", "lo"))
    far = spread.join(ends, ["key", "f"])
    if keep == "first":
        far = far.where(~_place("pos").eqNullSafe(F.col("lo")))
    far = far.select("doc_id", "h", F.col("pos").alias("first"), F.col("pos").alias("last"))
    return whole.unionByName(near).unionByName(far)


def removed_spans(flags: DataFrame, length: int) -> DataFrame:
    """Flagged starts -> (d, dh, spans): each document's maximal covered
    [first, last) byte ranges."""
    line = Window.partitionBy("doc_id", "h").orderBy("first", "last")
    reach = F.max("last").over(line.rowsBetween(Window.unboundedPreceding, -1)) + length
    f = flags.withColumn("new", F.when(F.col("first") <= reach, 0).otherwise(1))
    f = f.withColumn("span", F.sum("new").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return (f.groupBy("doc_id", "h", "span").agg(F.min("first").alias("first"), (F.max("last") + length).alias("last"))
            .groupBy(F.col("doc_id").alias("d"), F.col("h").alias("dh"))
            .agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("spans")))


def _remove():
    """(row columns.., text, spans) -> the kept text and what was removed."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                        ("n_spans", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for doc, text, spans in zip(*(batch.column(i) for i in range(3))):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                merged = [[s["first"], s["last"]] for s in spans.as_py() or []]
                parts, at = [], 0
                for a, b in merged:
                    parts.append(data[at:a])
                    at = b
                kept = b"".join([*parts, data[at:]])
                rows.append({"doc_id": doc.as_py(), "n_bytes": len(data), "n_removed": len(data) - len(kept),
                             "n_spans": len(merged), "spans": merged, "kept": kept})
                held += len(kept)
                if held > 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return run


def remove_repeats(docs: DataFrame, length: int = 400, keep: str = "first", w: int | None = None, k: int = 24,
                   wide: int = 5000) -> DataFrame:
    """Documents (doc_id, text) -> one row per document row: doc_id, n_bytes,
    n_removed, n_spans, spans (removed [start, end) byte ranges) and kept (the
    remaining bytes)."""
    k = min(k, length)
    w = w or max(1, min(256, length - k + 1))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "text")
    flags = written(flagged_starts(d, length, keep, w, k, wide), "flagged")
    spans = sized(written(removed_spans(flags, length), "spans"), "spans", 8)
    return (d.join(spans, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("dh")), "left")
            .select("doc_id", "text", "spans")
            .mapInArrow(_remove(), "doc_id long, n_bytes long, n_removed long, n_spans long, "
                                         "spans array<array<long>>, kept binary"))
