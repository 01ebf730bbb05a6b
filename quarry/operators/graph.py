"""Graph operators on two DataFrames: vertices (id) and edges (src, dst).

Iterative algorithms loop in Python with the work in Spark: each round is a
join + aggregation, the round's state is cut from its lineage with
``checkpoint()`` (in the shared checkpoint folder), and convergence is decided
by a count.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.expr import hash_uniform

# tasks get these functions by value: executors need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Iterations run until convergence, never to a round cap: every loop below
# makes progress each round (labels only decrease over a finite id set,
# vertices are removed, or new (vertex, landmark) pairs are found), so it ends.


def _ckpt(df: DataFrame) -> DataFrame:
    from quarry.session import last_use, shared_dir
    shared_dir(df.sparkSession)
    return last_use(df, lambda x: x.checkpoint())


def undirected(edges: DataFrame) -> DataFrame:
    """Both directions of every edge, self-loops dropped, deduplicated."""
    e = edges.select("src", "dst").where(F.col("src") != F.col("dst"))
    return e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()


def degrees(edges: DataFrame) -> DataFrame:
    """In + out degree per vertex (an edge counts once at each end)."""
    ends = edges.select(F.col("src").alias("id")).unionByName(edges.select(F.col("dst").alias("id")))
    return ends.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))


def _propagate_min(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """Smallest id reaching each vertex: repeat label(v) = min(label(v),
    label(u) for u -> v) until stable, with a pointer jump each round:
    label(v) = min(label(v), label(label(v))) - whatever reaches label(v)
    also reaches v - so a label crosses long chains in far fewer rounds."""
    cur = _ckpt(labels)
    while True:
        msg = (edges.join(cur.select(F.col("id").alias("src"), F.col("label").alias("m")), "src")
               .groupBy(F.col("dst").alias("id")).agg(F.min("m").alias("m")))
        step = (cur.join(msg, "id", "left")
                .select("id", F.least("label", F.coalesce("m", "label")).alias("label"), "m",
                        F.col("label").alias("old")))
        step = _ckpt(step)
        hop = step.select(F.col("id").alias("label"), F.col("label").alias("j"))
        nxt = (step.join(hop, "label", "left")
               .select("id", F.least("label", F.coalesce("j", "label")).alias("label"), "old")
               .withColumn("changed", F.col("label") < F.col("old")).drop("old"))
        nxt = _ckpt(nxt)
        if nxt.where(F.col("changed")).limit(1).count() == 0:
            return nxt.select("id", "label")
        cur = nxt.select("id", "label")


def connected_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component): component = smallest id reachable ignoring direction.

    Alternating large-star / small-star rounds (Kiveris et al., "Connected
    Components in MapReduce and Beyond", 2014): every round is two
    aggregations and two joins over the edge list, and the number of rounds
    grows with log(n) rather than with the graph diameter.  At convergence
    each component is a star around its smallest id.

    An edge is kept once, from its larger end to its smaller: a vertex's least
    neighbour is that of its edges down, or itself.  Rounds end when no edge
    leads to a vertex that has an edge down, and no vertex has two: these are
    stars.  Hand-offs are written as Parquet, whose small files are read many
    to a task, and removed when the next is there.
    """
    from quarry.session import handed_off
    far, near = F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")
    e, drop = handed_off(edges.where(F.col("src") != F.col("dst")).select(far, near).distinct(), "edges-down")
    while True:
        # large-star: link every larger neighbour of v to the min of v's closed neighbourhood
        down = e.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m"))
        large, drop_large = handed_off(e.join(down, "v", "left").select(
            "u", F.coalesce("m", "v").alias("v"), F.col("m").isNotNull().alias("moved")), "large-star")
        if large.where("moved").isEmpty() and large.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
            drop_large()
            break
        # small-star: link u and its smaller neighbours to the min of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        ends = F.explode(F.array("u", "v")).alias("u")
        small = large.join(least, "u").select(ends, F.col("m").alias("v")).where(F.col("u") != F.col("v")).distinct()
        nxt, drop_next = handed_off(small, "small-star")
        drop_large()
        drop()
        e, drop = nxt, drop_next
    return (vertices.select("id").join(e.withColumnsRenamed({"u": "id", "v": "m"}), "id", "left")
            .select("id", F.coalesce("m", "id").alias("component")))


def strongly_connected_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component): component = smallest id of the vertex's SCC.

    Trim, then colour: vertices without in- or out-edges inside the
    remaining graph are singleton SCCs and are peeled off; otherwise
    forward-propagate the smallest reaching id (colour); a vertex whose colour
    is its own id is a root; the root's SCC is the set of same-colour vertices
    that reach it (min labels over the reversed same-colour edges equal to
    the root).  Both propagations jump pointers.  Assign, remove, repeat on
    the rest.
    """
    e_all = _ckpt(edges.select("src", "dst").where(F.col("src") != F.col("dst")).distinct())
    rest = _ckpt(vertices.select("id"))
    done = None
    while rest.limit(1).count() > 0:   # each phase removes at least one vertex
        ids = rest.select("id")
        e = (e_all.join(ids.withColumnRenamed("id", "src"), "src")
             .join(ids.withColumnRenamed("id", "dst"), "dst"))
        # trim: a vertex without in-edges or without out-edges inside the rest
        # is a singleton SCC; peel those first (cheap, and it shrinks the
        # graph the propagation rounds walk over)
        has_in = e.select(F.col("dst").alias("id")).distinct()
        has_out = e.select(F.col("src").alias("id")).distinct()
        single = rest.join(has_in, "id", "left_anti").unionByName(rest.join(has_out, "id", "left_anti")).distinct()
        single = _ckpt(single.select("id", F.col("id").alias("component")))
        if single.limit(1).count() > 0:
            done = single if done is None else _ckpt(done.unionByName(single))
            rest = _ckpt(rest.join(single.select("id"), "id", "left_anti"))
            continue
        colour = _propagate_min(rest.select("id", F.col("id").alias("label")), e)
        # backward reach of each root inside its colour: reversed same-colour edges
        ce = (e.join(colour.select(F.col("id").alias("src"), F.col("label").alias("cs")), "src")
              .join(colour.select(F.col("id").alias("dst"), F.col("label").alias("cd")), "dst")
              .where(F.col("cs") == F.col("cd"))
              .select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        # Inside a colour the root is the smallest id, so v reaches the root
        # exactly when the min label over the reversed same-colour edges is
        # the root: the same pointer-jumping propagation decides it.
        back = _propagate_min(colour.select("id", F.col("id").alias("label")), ce)
        scc = (back.withColumnRenamed("label", "b").join(colour, "id")
               .where(F.col("b") == F.col("label")).select("id", F.col("label").alias("component")))
        scc = _ckpt(scc)
        done = scc if done is None else _ckpt(done.unionByName(scc))
        rest = _ckpt(rest.join(scc.select("id"), "id", "left_anti"))
    return done


#: oriented edges that a cell of the triangle grid should hold
CELL_EDGES = 3_000_000
#: wedges that a cell looks at together
CELL_WEDGES = 1 << 20


def _cell_triangles(table: pa.Table) -> pa.Table:
    """Triangles of one cell per vertex.  Rows (role, x, y) are oriented edges
    between three blocks of vertices: 0 first-second, 1 first-third, 2
    second-third.  For each first-second edge (u, v) the shorter of the sorted
    adjacency arrays of u and v in the third block is looked up in the other."""
    ids = pa.chunked_array([*table.column("x").chunks, *table.column("y").chunks]).combine_chunks().dictionary_encode()
    names, code = ids.dictionary, ids.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n = len(names)
    role = table.column("role").to_numpy()
    x, y = code[:len(code) // 2], code[len(code) // 2:]
    u, v = x[role == 0], y[role == 0]
    # an adjacency block is its sorted keys x * n + y and where each x begins
    keys = [np.sort(x[role == r] * n + y[role == r]) for r in (1, 2)]
    begin = [np.searchsorted(k, np.arange(n + 1) * n) for k in keys]
    size = [np.diff(b) for b in begin]
    found = np.zeros(n, np.int64)
    by_first = size[0][u] <= size[1][v]
    for own, other, this, that in ((0, 1, u[by_first], v[by_first]), (1, 0, v[~by_first], u[~by_first])):
        many = size[own][this]
        total = np.cumsum(many)
        at = 0
        while at < len(this):
            # whole edges up to CELL_WEDGES wedges: an adjacency array is never cut
            end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + CELL_WEDGES, side="right")))
            m = many[at:end]
            edge = np.repeat(np.arange(at, end), m)
            place = np.arange(len(edge)) - np.repeat(np.cumsum(m) - m, m) + begin[own][this[edge]]
            third = keys[own][place] % n
            want = that[edge] * n + third
            where = np.searchsorted(keys[other], want)
            hit = where < len(keys[other])
            hit[hit] = keys[other][where[hit]] == want[hit]
            for ends in (this[edge[hit]], that[edge[hit]], third[hit]):
                found += np.bincount(ends, minlength=n)
            at = end
    some = np.flatnonzero(found)
    return pa.table({"id": names.take(pa.array(some)), "n": pa.array(found[some])})


def triangle_count(vertices: DataFrame, edges: DataFrame, blocks: int | None = None) -> DataFrame:
    """Triangles through each vertex of the undirected simple graph (0 if none).

    Each edge is oriented from the lower-degree end to the higher (ties by
    id), which bounds every out-neighbourhood by O(sqrt(E)), hubs included.
    Vertices are dealt to ``blocks`` blocks, edges so to blocks x blocks, and
    a triangle u -> v -> w belongs to the cell of its three vertices' blocks.
    A cell gets its three edge blocks and intersects sorted adjacency arrays
    edge by edge, so no wedge is ever shuffled: each edge goes to 3 x blocks
    cells, and a cell holds about 3 E / blocks^2 edges whatever E is.
    """
    u = undirected(edges)
    deg = u.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("d"))
    x = (u.join(deg.select(F.col("id").alias("src"), F.col("d").alias("ds")), "src")
         .join(deg.select(F.col("id").alias("dst"), F.col("d").alias("dd")), "dst"))
    o = _ckpt(x.where((F.col("ds") < F.col("dd")) | ((F.col("ds") == F.col("dd")) & (F.col("src") < F.col("dst"))))
              .select("src", "dst"))
    if blocks is None:
        per = o.sparkSession.sparkContext.defaultParallelism
        blocks = max(math.ceil(math.sqrt(3 * o.count() / CELL_EDGES)), math.ceil((2 * per) ** (1 / 3)))

    def block(c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    every = F.sequence(F.lit(0), F.lit(blocks - 1))
    a, b = F.col("a"), F.col("b")

    def cells(role: int, first, second, third) -> Column:
        return F.transform(every, lambda k: F.struct(
            F.lit(role).alias("role"), ((first(k) * blocks + second(k)) * blocks + third(k)).alias("cell")))
    copies = F.concat(cells(0, lambda k: a, lambda k: b, lambda k: k), cells(1, lambda k: a, lambda k: k, lambda k: b),
                      cells(2, lambda k: k, lambda k: a, lambda k: b))
    dealt = (o.withColumn("a", block("src")).withColumn("b", block("dst"))
             .select(F.explode(copies).alias("c"), F.col("src").alias("x"), F.col("dst").alias("y"))
             .select("c.cell", "c.role", "x", "y").repartition(min(blocks ** 3, 20_000), "cell"))
    kind = o.schema["src"].dataType.simpleString()
    per = (dealt.groupBy("cell").applyInArrow(_cell_triangles, f"id {kind}, n long")
           .groupBy("id").agg(F.sum("n").alias("triangles")))
    return (vertices.select("id").join(per, "id", "left")
            .select("id", F.coalesce("triangles", F.lit(0)).cast("long").alias("triangles")))


def clustering_coefficient(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, triangles, degree, coef): t / (d (d - 1) / 2) on the undirected
    simple graph; NULL when d < 2 (so a mean skips it)."""
    t = triangle_count(vertices, edges)
    d = undirected(edges).groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("degree"))
    x = t.join(d, "id", "left").withColumn("degree", F.coalesce("degree", F.lit(0)).cast("long"))
    possible = F.col("degree") * (F.col("degree") - 1) / F.lit(2.0)
    return x.withColumn("coef", F.when(F.col("degree") >= 2, F.col("triangles") / possible))


def sample_vertices(vertices: DataFrame, fraction: float, seed: int = 1) -> DataFrame:
    """Bernoulli vertex sample by a hash of (id, seed): reproducible anywhere."""
    return vertices.where(hash_uniform(F.col("id"), F.lit(seed)) < F.lit(fraction))


def sample_landmarks(vertices: DataFrame, count: int, seed: int = 1, fraction: float = 0.0) -> DataFrame:
    """The vertices of ``sample_vertices`` at ``fraction``, and at least
    ``count`` vertices: those of the smallest hash of (id, seed)."""
    least = vertices.select("id").orderBy(hash_uniform(F.col("id"), F.lit(seed)), "id").limit(count)
    if not fraction:
        return least
    return sample_vertices(vertices.select("id"), fraction, seed).unionByName(least).distinct()


#: most landmarks searched for together
SWEEP = 4096
#: edges into a block of vertices, about
BLOCK_EDGES = 4_000_000
#: bytes of bitmaps that the sources of a block's edges bring along
BITMAPS = 64 << 20
#: words of bitmaps, or hops, looked at together
WORDS = 1 << 20

_BITS = "block int, kind int, rows binary, bits binary"


def _bits(block: list, kind: list, rows: list, bits: list) -> pa.Table:
    return pa.table([pa.array(block, pa.int32()), pa.array(kind, pa.int32()), pa.array([x.tobytes() for x in rows], pa.binary()),
                     pa.array([x.tobytes() for x in bits], pa.binary())], names=["block", "kind", "rows", "bits"])


def _read(t: pa.Table, words: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    return [(k, np.frombuffer(r, np.int32), np.frombuffer(b, np.uint64).reshape(-1, words))
            for k, r, b in zip(t.column("kind").to_pylist(), t.column("rows").to_pylist(), t.column("bits").to_pylist())]


def _lay_edges(key, t):
    """The edges into one block: its vertices that have some, where each one's
    start, the sources, and each edge's place among them."""
    src, dst = (t.column(c).to_numpy() for c in ("src", "dst"))
    order = np.lexsort((src, dst))
    rows, starts = np.unique(dst[order], return_index=True)
    named, place = np.unique(src[order], return_inverse=True)
    parts = (rows.astype(np.int32), np.append(starts, len(dst)).astype(np.int64), named.astype(np.int32), place.astype(np.int32))
    return pa.table({"block": pa.array([key[0].as_py()], pa.int32()),
                     **{n: pa.array([x.tobytes()], pa.binary()) for n, x in zip(("rows", "starts", "named", "place"), parts)}})


def _wanted(keys: list[int]):
    """Which vertices of each block a block's edges come from."""
    def run(batches):
        for batch in batches:
            for to, named in zip(batch.column("block").to_pylist(), batch.column("named").to_pylist()):
                named = np.frombuffer(named, np.int32)
                of = named % len(keys)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int32()), pa.array([to] * len(keys), pa.int32()),
                     pa.array([named[of == o].tobytes() for o in range(len(keys))], pa.binary())], names=["block", "to", "rows"])
    return run


def _marks(words: int):
    """A block's landmarks, each with its own bit."""
    def run(key, t):
        idx, pos = (t.column(c).to_numpy() for c in ("idx", "pos"))
        order = np.argsort(idx)
        bits = np.zeros((len(idx), words), np.uint64)
        bits[np.arange(len(idx)), pos[order] // 64] = np.uint64(1) << (pos[order] % 64).astype(np.uint64)
        rows = idx[order].astype(np.int32)
        block = key[0].as_py()
        return _bits([block, block], [0, 1], [rows, rows], [bits, bits])
    return run


def _send(words: int):
    """A block's new bitmaps, to the blocks that have edges from the vertices."""
    def run(left, right):
        new = _read(right, words)
        if not new:
            return _bits([], [], [], [])
        _, rows, bits = new[0]
        to, out = [], []
        for block, want in zip(left.column("to").to_pylist(), left.column("rows").to_pylist()):
            _, at, _ = np.intersect1d(rows, np.frombuffer(want, np.int32), assume_unique=True, return_indices=True)
            if len(at):
                to.append(block)
                out.append(at)
        return _bits(to, [2] * len(to), [rows[at] for at in out], [bits[at] for at in out])
    return run


def _receive(words: int):
    """Bitmaps or-ed along a block's edges: the new bits of its vertices (kind
    0) and all bits they have by now (kind 1)."""
    def run(left, right):
        if not left.num_rows or not right.num_rows:
            return _bits([], [], [], [])
        block = left.column("block")[0].as_py()
        rows, starts, named, place = (np.frombuffer(left.column(n)[0].as_py(), k) for n, k in (
            ("rows", np.int32), ("starts", np.int64), ("named", np.int32), ("place", np.int32)))
        source, on = np.zeros((len(named), words), np.uint64), np.zeros(len(named), bool)
        seen_rows, seen = rows[:0], np.zeros((0, words), np.uint64)
        for kind, r, b in _read(right, words):
            if kind == 2:
                at = np.searchsorted(named, r)
                source[at], on[at] = b, True
            else:
                seen_rows, seen = r, b
        # edges from vertices that sent something
        live = np.flatnonzero(on[place])
        to = np.searchsorted(starts, live, side="right") - 1
        first = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else live
        hit, place, ends = rows[to[first]], place[live], np.append(first, len(live))
        new = np.empty((len(hit), words), np.uint64)
        lo = 0
        while lo < len(hit):
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + WORDS // words, side="right")) - 1)
            got = source[place[ends[lo]:ends[hi]]]
            new[lo:hi] = np.bitwise_or.reduceat(got, ends[lo:hi] - ends[lo], axis=0)
            lo = hi
        every = np.union1d(seen_rows, hit)
        total = np.zeros((len(every), words), np.uint64)
        total[np.searchsorted(every, seen_rows)] = seen
        at = np.searchsorted(every, hit)
        new &= ~total[at]
        total[at] |= new
        some = new.any(axis=1)
        if not some.any():
            return _bits([block], [1], [every], [total])
        return _bits([block, block], [0, 1], [hit[some], every], [new[some], total])
    return run


def _hops(blocks: int, per: int, last: int):
    """The landmarks that reach each vertex of a block, and in how many hops, from
    the new bits of every sweep and round."""
    words = -(-per // 64)

    def run(left, right):
        kind = right.schema.field("names").type
        empty = pa.schema([("id", kind.value_type), ("landmarks", kind), ("hops", pa.list_(pa.int32()))]).empty_table()
        if not left.num_rows:   # fewer vertices than blocks
            return empty
        ids = left.column("ids").combine_chunks().flatten()
        names, news = {}, []
        for sweep, step, r, b, n in zip(*(right.column(c) for c in ("sweep", "step", "rows", "bits", "names"))):
            if r.is_valid:
                news.append((sweep.as_py(), step.as_py(), np.frombuffer(r.as_py(), np.int32) // blocks,
                             np.frombuffer(b.as_py(), np.uint64).reshape(-1, words)))
            else:
                names[sweep.as_py()] = n.values
        marks = pa.concat_arrays([names[i] for i in sorted(names)])
        out = []
        height = max(1, WORDS // max(1, len(marks)))
        for lo in range(0, len(ids), height):
            hops = np.full((min(height, len(ids) - lo), len(marks)), -1, np.int32)
            for sweep, step, rows, bits in news:
                a, z = np.searchsorted(rows, (lo, lo + height))
                if a < z:
                    n = min(per, last - sweep * per)
                    on = np.unpackbits(np.ascontiguousarray(bits[a:z]).view(np.uint8), axis=1, bitorder="little")[:, :n]
                    r, c = np.nonzero(on)
                    hops[rows[a:z][r] - lo, c + sweep * per] = step
            r, c = np.nonzero(hops >= 0)
            n = np.bincount(r, minlength=len(hops))
            some = np.flatnonzero(n)
            if len(some):
                ends = pa.array(np.append(0, np.cumsum(n[some])), pa.int32())
                out.append(pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(some + lo)), pa.ListArray.from_arrays(ends, marks.take(pa.array(c))),
                     pa.ListArray.from_arrays(ends, pa.array(hops[r, c]))], names=["id", "landmarks", "hops"]))
        return pa.Table.from_batches(out) if out else empty
    return run


def landmark_hops(landmarks: DataFrame, edges: DataFrame) -> DataFrame:
    """Hop counts of the shortest directed paths from the landmarks, by
    breadth-first search of many landmarks at a time.

    A landmark is a bit position in a bitmap of long words.  Vertices are dealt
    to blocks, and the edges into a block are laid out once for all rounds and
    sweeps.  In a round each vertex's new bits go to the blocks that have
    edges from it, where they are or-ed along the edges; edges are never
    shuffled again.  A task holds one block's edges and the bitmaps of their
    sources, BITMAPS bytes about: this sets how many landmarks go together.

    Returns (id, landmarks, hops): for each vertex that some landmark
    reaches, those landmarks and their distances, as two arrays.
    """
    from quarry.operators.recommend import item_index
    from quarry.session import even_keys, last_use
    spark = edges.sparkSession
    kind = landmarks.schema["id"].dataType.simpleString()
    e = _ckpt(edges.select("src", "dst").where(F.col("src") != F.col("dst")).distinct())
    ends = e.select(F.col("src").alias("item")).unionByName(e.select(F.col("dst").alias("item")))
    index = _ckpt(item_index(ends.unionByName(landmarks.select(F.col("id").alias("item"))))
                  .select(F.col("item").alias("id"), F.col("idx").cast("int").alias("idx")))
    order = _ckpt(item_index(landmarks.select(F.col("id").alias("item"))).select(F.col("item").alias("id"), F.col("idx").alias("pos"))
                  .join(index, "id"))
    total, vertices = order.count(), index.count()
    blocks = max(spark.sparkContext.defaultParallelism, -(-e.count() // BLOCK_EDGES))
    per = min(SWEEP, max(64, BITMAPS * 8 // max(1, min(vertices, BLOCK_EDGES)) // 64 * 64))
    words = -(-per // 64)
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = even_keys(spark, shuffle, blocks)[:blocks]

    def block(idx: str) -> Column:
        return F.get(F.lit(keys), F.col(idx) % blocks).alias("block")

    def kept(df):
        # cogroups read it where it is
        return last_use(df.repartition(shuffle, "block").sortWithinPartitions("block"), lambda x: x.checkpoint())
    numbered = (e.join(index.withColumnsRenamed({"id": "src", "idx": "s"}), "src").join(index.withColumnsRenamed({"id": "dst", "idx": "d"}), "dst")
                .select(block("d"), F.col("s").alias("src"), F.col("d").alias("dst")))
    laid = kept(numbered.groupBy("block").applyInArrow(_lay_edges, "block int, rows binary, starts binary, named binary, place binary"))
    wanted = kept(laid.select("block", "named").mapInArrow(_wanted(keys), "block int, to int, rows binary").where(F.length("rows") > 0))
    # the block's vertices in the order of their numbers
    entry = F.array_sort(F.collect_list(F.struct("idx", "id")))
    who = kept(index.groupBy(block("idx")).agg(F.transform(entry, lambda x: x["id"]).alias("ids")))
    found = None
    for sweep in range(-(-total // per)):
        names = order.where(F.floor(F.col("pos") / per) == sweep).withColumn("pos", F.col("pos") % per)
        got = _ckpt(names.select(block("idx"), "idx", "pos").groupBy("block").applyInArrow(_marks(words), _BITS))
        listed = names.agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "id"))), lambda x: x["id"]).alias("names"))
        step = 0
        # names are at most SWEEP
        rows = spark.createDataFrame([(k,) for k in keys], "block int").crossJoin(F.broadcast(listed)).select(
            "block", F.lit(sweep).alias("sweep"), F.lit(-1).alias("step"), F.lit(None).cast("binary").alias("rows"),
            F.lit(None).cast("binary").alias("bits"), "names")
        found = rows if found is None else found.unionByName(rows)
        while True:
            new = got.where("kind = 0")
            if new.limit(1).count() == 0:
                break
            found = found.unionByName(new.select("block", F.lit(sweep).alias("sweep"), F.lit(step).alias("step"), "rows", "bits",
                                                 F.lit(None).cast(f"array<{kind}>").alias("names")))
            sent = wanted.groupBy("block").cogroup(new.groupBy("block")).applyInArrow(_send(words), _BITS)
            right = sent.unionByName(got.where("kind = 1"))
            got = _ckpt(laid.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(_receive(words), _BITS))
            step += 1
    schema = f"id {kind}, landmarks array<{kind}>, hops array<int>"
    if found is None:
        return spark.createDataFrame([], schema)
    return who.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(_hops(blocks, per, total), schema)


def landmark_distances(landmarks: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, landmark, dist): hop count of the shortest directed path from each
    landmark to each vertex it reaches."""
    pairs = F.explode(F.arrays_zip("landmarks", "hops")).alias("x")
    return landmark_hops(landmarks, edges).select("id", pairs).select(
        "id", F.col("x.landmarks").alias("landmark"), F.col("x.hops").alias("dist"))


def landmark_maps(vertices: DataFrame, landmarks: DataFrame, edges: DataFrame) -> DataFrame:
    """Map form, one row per vertex: (id, map landmark -> hops); {} for
    vertices no landmark reaches.  Each vertex starts with an empty map, which
    is merged with what was found key by key, once for all sweeps."""
    kind = vertices.schema["id"].dataType.simpleString()
    empty = F.create_map().cast(f"map<{kind},int>")
    found = landmark_hops(landmarks, edges).select("id", F.map_from_arrays("landmarks", "hops").alias("m"))
    return (vertices.select("id", empty.alias("map")).join(found, "id", "left")
            .select("id", merge_min_maps(F.col("map"), F.coalesce("m", empty)).alias("map")))


def merge_min_maps(a, b):
    """Key-wise minimum of two maps (missing = +inf)."""
    return F.map_zip_with(a, b, lambda k, x, y: F.least(x, y))


def landmark_maps_pregel(vertices: DataFrame, edges: DataFrame, landmarks: DataFrame) -> DataFrame:
    """Shortest hop maps by message passing: landmarks start with {self: 0},
    the rest with {}; every round each source sends its map with all values
    + 1 (``transform_values``) to its out-neighbours, messages to one vertex
    are combined key-wise by min, and merged into the vertex's map
    (``map_zip_with`` min).  Stops when no map changes.  Messages are
    exploded to (dst, landmark, hops) and aggregated, so a vertex's inbox is
    never collected; a map holds at most one entry per landmark."""
    e = edges.select("src", "dst").where(F.col("src") != F.col("dst")).distinct()
    e = _ckpt(e)
    lm = landmarks.select("id", F.lit(True).alias("is_lm"))
    empty = F.create_map().cast("map<bigint,int>")
    state = _ckpt(vertices.select("id").join(lm, "id", "left").select(
        "id", F.when(F.col("is_lm"), F.create_map(F.col("id"), F.lit(0))).otherwise(empty).alias("map")))
    while True:
        sent = (e.join(state.select(F.col("id").alias("src"), "map"), "src")
                .where(F.size("map") > 0)
                .select("dst", F.explode(F.transform_values("map", lambda k, v: v + 1)).alias("lmk", "hops")))
        inbox = (sent.groupBy("dst", "lmk").agg(F.min("hops").alias("hops"))
                 .groupBy(F.col("dst").alias("id"))
                 .agg(F.map_from_entries(F.collect_list(F.struct("lmk", "hops"))).alias("msg")))
        merged = (state.join(inbox, "id", "left")
                  .withColumn("new", F.when(F.col("msg").isNull(), F.col("map"))
                              .otherwise(merge_min_maps(F.col("map"), F.col("msg"))))
                  .withColumn("changed", F.coalesce(
                      F.exists(F.map_entries("new"),
                               lambda x: F.coalesce(F.col("map")[x["key"]] != x["value"], F.lit(True))),
                      F.lit(False))))
        merged = _ckpt(merged.select("id", F.col("new").alias("map"), "changed"))
        state = merged.select("id", "map")
        if merged.where(F.col("changed")).limit(1).count() == 0:
            break
    return state


def pagerank(vertices: DataFrame, edges: DataFrame, alpha: float = 0.15,
             iterations: int = 5) -> DataFrame:
    """rank <- alpha / N + (1 - alpha) * sum over in-edges of rank(src) / outdeg(src),
    from rank = 1 / N, for a fixed number of rounds."""
    n = vertices.select(F.count(F.lit(1)).cast("double")).scalar()
    e = edges.select("src", "dst")
    out = e.groupBy(F.col("src")).agg(F.count(F.lit(1)).alias("outdeg"))
    e = _ckpt(e.join(out, "src"))
    rank = _ckpt(vertices.select("id", (F.lit(1.0) / n).alias("rank")))
    for _ in range(iterations):
        contrib = (e.join(rank.select(F.col("id").alias("src"), "rank"), "src")
                   .groupBy(F.col("dst").alias("id"))
                   .agg(F.sum(F.col("rank") / F.col("outdeg")).alias("s")))
        rank = _ckpt(vertices.select("id").join(contrib, "id", "left").select(
            "id", (F.lit(alpha) / n + F.lit(1.0 - alpha) * F.coalesce("s", F.lit(0.0))).alias("rank")))
    return rank
