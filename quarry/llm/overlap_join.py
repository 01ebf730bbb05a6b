"""N-gram Jaccard join by T-occurrence search (merge of short inverted lists,
binary probes into long ones: DivideSkip).

Two documents link when num / den of the union of their shingle sets is
shared.  Steps, each over all documents:

1. Every text becomes its set of k-word shingles (64-bit hashes).  Equal sets
   are one class, known by its size and a 128-bit fingerprint, with its
   smallest doc_id.
2. Similar sets share a shingle among the first ``n - ceil(n * num/den) + 1``
   of each, in any fixed order of shingles (prefix filter).  The order: a
   fifth of all shingles, chosen by hash, rarest first by their exact count
   over all classes, then the others by hash.  So a class's prefix holds what
   it shares only if it has too little of its own; classes whose prefix meets
   no other have no partner.
3. Per shared prefix shingle the smallest class is the pivot; each class is
   searched against its smallest pivot: the pivot's set is the query, the
   classes that picked it, in chunks, are the inverted index.  A large group
   of near copies costs one search a chunk, not all pairs.
   Shared shingles count only between classes of like size (bands).
4. Classes whose shared shingles still span several components are gathered
   in cells (components of the remaining candidates of a band), cut in chunks
   of bounded size along components; every two chunks of a cell meet once, each
   home member of one searched in the index of the other.  Chunks of one single component do
   not meet each other: their classes are connected already.

No pair that reaches the threshold can be missed between different
components, so components are exact; the links of steps 3 and 4 only span them.
All links lie inside components, so ``links`` and ``link_counts`` then search
each component in full (step 5): one of at most a chunk at once, a larger one in
bands and chunks, every two chunks of a band meeting once.

Defined results: null and empty texts have an empty set and link with
nothing; a null doc_id links with nothing and has no component; in the components
of ``near_duplicates`` and ``link_counts`` rows that share a doc_id are one
node of the graph, each with its own set and links; an empty
table gives no rows.  Other columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import bytehash
from quarry.llm.common import bounded, written
from quarry.operators.graph import connected_components

#: most shingles of one chunk (8 bytes each, a few times over)
CHUNK = 1_000_000


def counted_share(num: int, den: int) -> int:
    """One shingle in so many is counted for the order: enough that a set's
    counted shingles outnumber its prefix by a third, so that a set that
    shares little has a prefix of shingles that are its own."""
    return max(1, int(den / (1.3 * (den - num)))) if num < den else 5


def _i64(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def needed(a, b, num: int, den: int):
    """Smallest overlap of sets of a and b elements that reaches num/den of
    their union."""
    return -((-num * (a + b)) // (num + den))


class Lists:
    """Inverted index of sets: for each shingle the sorted list of members."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        tok = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        who = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(tok, kind="stable")
        tok, self.who = tok[order], who[order]
        self.tokens, self.start = np.unique(tok, return_index=True)
        self.end = np.append(self.start[1:], len(tok))

    def search(self, q: np.ndarray, num: int, den: int) -> list[int]:
        """Members whose overlap with q reaches the threshold (DivideSkip).

        The T of the search is the least any allowed partner needs.  The
        longest lists are set aside; a member must appear often enough in the
        short ones, which are merged (sorted runs, by a merging sort in place
        of a heap: the same sequence, compiled), and is then counted on by
        binary probes into the long lists, as long as it can still reach T.
        """
        n = len(q)
        t = max(1, -((-num * n) // den))
        at = np.searchsorted(self.tokens, q)
        at[at == len(self.tokens)] = 0
        at = at[self.tokens[at] == q] if len(self.tokens) else at[:0]
        if len(at) < t:
            return []
        s, e = self.start[at], self.end[at]
        by = np.argsort(s - e, kind="stable")           # longest first
        longest = int(e[by[0]] - s[by[0]])
        aside = min(t - 1, int(t / (0.01 * np.log2(longest + 1) + 1)))
        short = np.sort(np.concatenate([self.who[s[i]:e[i]] for i in by[aside:]]), kind="stable")
        edge = np.flatnonzero(np.diff(short, prepend=-1, append=-1))
        member, count = short[edge[:-1]], np.diff(edge)
        want = np.maximum(t, needed(n, self.sizes[member], num, den))
        for left in range(aside, -1, -1):               # long lists not probed yet
            may = count + left >= want
            member, count, want = member[may], count[may], want[may]
            if not left or not len(member):
                break
            i = by[left - 1]                            # the shortest of the long lists first
            p = self.who[s[i]:e[i]]
            at = np.minimum(np.searchsorted(p, member), len(p) - 1)
            count = count + (p[at] == member)
        return member.tolist()


def _text_sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[object, np.ndarray]]:
    for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
        yield i, bytehash.shingles(bytehash.word_hashes(t.as_py() or ""), k)


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    if not len(s):
        return 0, 0
    a = bytehash.mix(np.array([s.sum(dtype=np.uint64) + np.uint64(len(s))], np.uint64))
    b = bytehash.mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return int(_i64(a)[0]), int(np.int64(b.view(np.int64)))


def _counted(s: np.ndarray, every: int) -> np.ndarray:
    return _i64(s) % every == 0


PROFILE = "doc_id long, h long, n long, f1 long, f2 long, m long, tokens array<long>"


def _profile(k: int, num: int, den: int):
    """(doc_id, text, h) -> size, fingerprint and number of counted shingles of
    each set, and its ``tokens``: the counted shingles, and others in the order
    of their hash where those are fewer than a prefix."""
    every = counted_share(num, den)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, tok = [], []
            for _, s in _text_sets(batch, k):
                own = _counted(s, every)
                m = int(own.sum())
                more = len(s) + ((-num * len(s)) // den) + 1 - m if len(s) else 0
                rows.append((len(s), *fingerprint(s), m))
                tok.append(_i64(s[own]) if more <= 0 else np.concatenate([_i64(s[own]), np.sort(_i64(s[~own]))[:more]]))
            ends = np.cumsum([0] + [len(t) for t in tok])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), *(pa.array([r[i] for r in rows], pa.int64()) for i in range(4)),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(tok or [np.zeros(0, np.int64)])))],
                names=["doc_id", "h", "n", "f1", "f2", "m", "tokens"])
    return run


def _shared_prefixes(rows: DataFrame, num: int, den: int) -> DataFrame:
    """(token, v, n, m) of shingles in several classes -> the (token, v)
    that are in the prefixes of several classes."""
    df = rows.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    several = rows.join(df, "token").withColumn("exact", F.pmod("token", F.lit(counted_share(num, den))) == 0)
    own = Window.partitionBy("v")
    place = F.row_number().over(own.orderBy(F.desc("exact"), "c", "token"))
    prefix = F.col("n") - F.ceil(F.col("n") * num / den) + 1
    # counted shingles that no other class has come first in the order, and meet nothing
    alone = F.col("m") - F.count(F.when(F.col("exact"), 1)).over(own)
    first = several.withColumn("place", place).withColumn("alone", alone).where(F.col("place") <= prefix - F.col("alone"))
    first = written(first.select("token", "v").distinct(), "prefix-rows")
    met = first.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("token")
    return first.join(met, "token")


LINKS = "src long, dst long"


def _link_batch(pairs: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"src": pa.array([a for a, _ in pairs], pa.int64()),
                     "dst": pa.array([b for _, b in pairs], pa.int64())})


def _search_chunks(k: int, num: int, den: int, give: str):
    """One group = one meeting of chunks, its texts turned into sets here.
    Roles: 0 the query of an index of 1; 2 both query and index, with 1 index
    only; and where two chunks meet, 3 / 4 the lower chunk's home and other
    members, 5 / 6 those of the higher.  ``give``: "span" - pairs that are connected
    already (same component, or by links found here) yield no link; "pairs" -
    every pair, once; "counts" - each member's number of pairs, as ``dst``."""
    def run(group: pa.Table) -> pa.Table:
        role = np.array(group["role"].to_pylist())
        v, comp = group["v"].to_pylist(), group["comp"].to_pylist()
        sets = [bytehash.shingles(bytehash.word_hashes(t.as_py() or ""), k) for t in group["text"]]
        up: dict[int, int] = {}

        def root(x):
            while up.get(x, x) != x:
                up[x] = up.get(up[x], up[x])
                x = up[x]
            return x
        out = []
        found = np.zeros(len(sets), np.int64)
        for asked, held in ((0, (1,)), (2, (1, 2)), (3, (5, 6)), (5, (4,))):
            base = np.flatnonzero(np.isin(role, held))
            queries = np.flatnonzero(role == asked)
            if not len(base) or not len(queries):
                continue
            index = Lists([sets[i] for i in base])
            for i in queries:
                for j in index.search(sets[i], num, den):
                    if give != "span":
                        # two queries of one index find each other twice
                        if base[j] != i and (role[base[j]] != asked or v[i] < v[base[j]]):
                            found[i] += 1
                            found[base[j]] += 1
                            if give == "pairs":
                                out.append((v[i], v[base[j]]))
                        continue
                    a, b = root(comp[i]), root(comp[base[j]])
                    if a != b:
                        up[max(a, b)] = min(a, b)
                        out.append((v[i], v[base[j]]))
        if give == "counts":
            out = [(a, int(n)) for a, n in zip(v, found) if n]
        return _link_batch(out)
    return run


def _band(num: int, den: int):
    return F.floor(F.log("n") / math.log(1.01 * den / num))


def _banded(shared: DataFrame, size: DataFrame, num: int, den: int) -> DataFrame:
    """(token, v) -> (token, v, band, home): linked sets differ in size by at
    most den/num, so with bands a little wider a class meets its partners in
    its own (home) band or the one above.  Tokens become tokens of a band;
    those with one class left go."""
    b = _band(num, den)
    rows = shared.join(size, "v").withColumn("own", b).select(
        F.col("token").alias("t"), "v", "own", F.explode(F.array(b, b + 1)).alias("band"))
    rows = rows.select(F.xxhash64("t", "band").alias("token"), "v", "band", (F.col("band") == F.col("own")).alias("home"))
    met = rows.groupBy("token").agg(F.count(F.lit(1)).alias("c"), F.max("home").alias("any")).where("c > 1 and any")
    return rows.join(met.select("token"), "token")


def _meet(texts: DataFrame, roles: DataFrame, classes: DataFrame, k: int, num: int, den: int,
          give: str = "span") -> DataFrame:
    """Searches each (cell, lo, hi) group of ``roles`` (cell, lo, hi, v, comp,
    role).  Texts travel, once for each role, not sets: they are a third of
    the size."""
    roles = written(roles.join(classes.select("v", "doc_id", "h"), "v"), "roles")
    rows = texts.join(bounded(roles, 192), ["doc_id", "h"]).select("cell", "lo", "hi", "v", "comp", "role", "text")
    spark = texts.sparkSession
    n = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return (rows.repartition(n, "cell", "lo", "hi").groupBy("cell", "lo", "hi")
            .applyInArrow(_search_chunks(k, num, den, give), LINKS))


def _pivot_roles(shared: DataFrame, size: DataFrame) -> DataFrame:
    """Step 3: each class with the pivot that it picked, in chunks, and the
    pivot as the query of each chunk."""
    pivot = shared.groupBy("token").agg(F.min("v").alias("pivot"))
    pick = (shared.join(pivot, "token").where("v <> pivot").groupBy("v").agg(F.min("pivot").alias("cell")))
    pick = written(pick.join(size, "v"), "picks")
    total = pick.groupBy("cell").agg(F.ceil(F.sum("n") / CHUNK).cast("int").alias("chunks"))
    zero = F.lit(0).cast("long")
    members = pick.join(total, "cell").select(
        "cell", zero.alias("lo"), F.pmod(F.xxhash64("v"), F.col("chunks")).alias("hi"), "v",
        F.col("v").alias("comp"), F.lit(1).alias("role"))
    asked = total.select("cell", zero.alias("lo"), F.explode(F.sequence(zero, F.col("chunks") - 1)).alias("hi"),
                         F.col("cell").alias("v"), F.col("cell").alias("comp"), F.lit(0).alias("role"))
    return members.unionByName(asked)


def _cell_roles(shared: DataFrame, comp: DataFrame, size: DataFrame) -> DataFrame:
    """Step 4: the members of cells, in chunks that meet."""
    s = shared.join(comp, "v").select("token", "v", "band", "home", "comp")
    mixed = (s.groupBy("token").agg(F.min("comp").alias("a"), F.max("comp").alias("b"), F.min("v").alias("first"))
             .where("a <> b").select("token", "first"))
    rest = written(s.join(mixed, "token").select(
        F.xxhash64("v", "band").alias("id"), F.xxhash64("first", "band").alias("to"), "v", "band", "home", "comp")
        .distinct(), "undecided")
    cells = connected_components(rest.select("id").distinct(),
                                 rest.select(F.col("id").alias("src"), F.col("to").alias("dst")).distinct())
    m = (rest.select("id", "v", "home", "comp").distinct()
         .join(cells.withColumnRenamed("component", "cell"), "id").join(size, "v").drop("id"))
    m = written(m, "cell-members")
    per = m.groupBy("cell", "comp").agg(F.sum("n").alias("w"))
    # a component of more than a chunk has chunks of its own; smaller ones fill chunks together
    big = F.col("w") > CHUNK
    own = F.when(big, F.ceil(F.col("w") / CHUNK)).otherwise(0).cast("long")
    order = Window.partitionBy("cell").orderBy("comp").rowsBetween(Window.unboundedPreceding, -1)
    per = (per.withColumn("own", own)
           .withColumn("before", F.coalesce(F.sum("own").over(order), F.lit(0)))
           .withColumn("fill", F.coalesce(F.sum(F.when(big, 0).otherwise(F.col("w"))).over(order), F.lit(0)))
           .withColumn("owned", F.sum("own").over(Window.partitionBy("cell")))
           .withColumn("small", F.sum(F.when(big, 0).otherwise(F.col("w"))).over(Window.partitionBy("cell")))
           .withColumn("chunks", (F.col("owned") + F.floor(F.col("small") / CHUNK) + 1).cast("long")))
    m = m.join(per, ["cell", "comp"]).withColumn(
        "chunk", F.when(F.col("own") > 0, F.col("before") + F.pmod(F.xxhash64("v"), F.col("own")))
        .otherwise(F.col("owned") + F.floor(F.col("fill") / CHUNK)))
    # each chunk meets itself (unless it is of one component) and every chunk but those of its own component
    meet = m.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).where(
        (F.col("own") == 0) | (F.col("other") < F.col("before")) | (F.col("other") >= F.col("before") + F.col("own")))
    return meet.select("cell", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"), "v", "comp",
                       F.when(F.col("chunk") == F.col("other"), F.when(F.col("home"), 2).otherwise(1))
                       .otherwise(F.when(F.col("chunk") < F.col("other"), F.when(F.col("home"), 3).otherwise(4))
                                  .otherwise(F.when(F.col("home"), 5).otherwise(6))).alias("role"))


def _components(ids: DataFrame, links: DataFrame) -> DataFrame:
    return (connected_components(ids.select(F.col("v").alias("id")), links)
            .select(F.col("id").alias("v"), F.col("component").alias("comp")))


def _link_roles(comp: DataFrame, size: DataFrame, num: int, den: int) -> DataFrame:
    """Step 5: the members of each component of several classes, so that any
    two of like size meet once."""
    m = comp.join(size, "v")
    total = m.groupBy("comp").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("w")).where("c > 1")
    m = written(m.join(total, "comp"), "component-members")
    zero = F.lit(0).cast("long")
    small = m.where(F.col("w") <= CHUNK).select(
        F.col("comp").alias("cell"), zero.alias("lo"), zero.alias("hi"), "v", "comp", F.lit(2).alias("role"))
    b = _band(num, den)
    large = m.where(F.col("w") > CHUNK).withColumn("own", b).withColumn("band", F.explode(F.array(b, b + 1)))
    large = large.select("comp", "band", "v", "n", (F.col("band") == F.col("own")).alias("home"))
    per = large.groupBy("comp", "band").agg(F.ceil(F.sum("n") / CHUNK).cast("long").alias("chunks"),
                                            F.max("home").alias("any")).where("any").drop("any")
    meet = (large.join(per, ["comp", "band"])
            .withColumn("chunk", F.pmod(F.xxhash64("v"), F.col("chunks")))
            .withColumn("other", F.explode(F.sequence(zero, F.col("chunks") - 1))))
    home = F.col("home")
    return small.unionByName(meet.select(
        F.xxhash64("comp", "band").alias("cell"), F.least("chunk", "other").alias("lo"),
        F.greatest("chunk", "other").alias("hi"), "v", "comp",
        F.when(F.col("chunk") == F.col("other"), F.when(home, 2).otherwise(1))
        .when(F.col("chunk") < F.col("other"), F.when(home, 3).otherwise(4))
        .otherwise(F.when(home, 5).otherwise(6)).alias("role")))


class Found(NamedTuple):
    """``rows``: profiles of all rows; ``classes``: v, n, f1, f2, m and the row
    (doc_id, h) that stands for each; ``comp``: v, comp of the classes that may
    have a partner; ``texts``: doc_id, h, text, a row that repeats in full
    once."""
    rows: DataFrame
    classes: DataFrame
    comp: DataFrame
    texts: DataFrame


def text_hash(text):
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _texts_once(d: DataFrame, rows: DataFrame) -> DataFrame:
    again = written(rows.where("n > 0 and doc_id is not null").groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("c"))
                    .where("c > 1").select("doc_id", "h"), "repeated-rows")
    if again.limit(1).count() == 0:
        return d
    again = bounded(again, 32)
    one = d.join(again, ["doc_id", "h"], "left_semi").groupBy("doc_id", "h").agg(F.max("text").alias("text"))
    return d.join(again, ["doc_id", "h"], "left_anti").unionByName(written(one, "repeated-texts"))


def find(docs: DataFrame, k: int, num: int, den: int) -> Found:
    """Steps 1 to 4: classes of (doc_id, text) and their exact components."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("h", text_hash(F.col("text")))
    rows = written(d.select("doc_id", "text", "h").mapInArrow(_profile(k, num, den), PROFILE), "profiles")
    classes = written(rows.where("n > 0 and doc_id is not null").groupBy("n", "f1", "f2", "m")
                      .agg(F.min(F.struct("doc_id", "h")).alias("r"))
                      .select(F.monotonically_increasing_id().alias("v"), "n", "f1", "f2", "m", "r.doc_id", "r.h"), "classes")
    texts = _texts_once(d, rows)
    # widths as the driver holds a broadcast row: collected, hashed at up to twice the room, in blocks
    # one row of each class gives its shingles (repeated rows of a text give them again)
    reps = bounded(classes.select("doc_id", "h", "v"), 128)
    pre = rows.join(reps, ["doc_id", "h"]).select("v", F.explode("tokens").alias("token"))
    multi = written(pre.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("token"), "shared-tokens")
    several = written(pre.join(bounded(multi, 96), "token").distinct()
                      .join(classes.select("v", "n", "m"), "v"), "shared-rows")
    shared = written(_shared_prefixes(several, num, den), "shared")
    size = classes.select("v", "n")
    shared = written(_banded(shared, size, num, den), "banded")
    ids = written(shared.select("v").distinct(), "candidates")
    links = written(_meet(texts, _pivot_roles(shared, size), classes, k, num, den), "pivot-links")
    comp = written(_components(ids, links), "components")
    more = written(_meet(texts, _cell_roles(shared, comp, size), classes, k, num, den), "cell-links")
    comp = written(_components(ids, links.unionByName(more)), "components")
    return Found(rows, classes, comp, texts)


def _tied(f: Found) -> DataFrame:
    """The components, with rows that share a doc_id as one node: their
    classes are linked."""
    again = f.rows.where("n > 0 and doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    tied = f.rows.join(again, "doc_id").join(f.classes.select("v", "n", "f1", "f2", "m"), ["n", "f1", "f2", "m"])
    tied = tied.join(f.comp, "v", "left").select("doc_id", F.coalesce("comp", "v").alias("v")).distinct()
    tied = tied.join(tied.groupBy("doc_id").agg(F.min("v").alias("src")), "doc_id").where("v <> src")
    tied = written(tied.select("src", F.col("v").alias("dst")), "repeated-ids")
    if tied.limit(1).count() == 0:
        return f.comp
    ids = tied.select(F.col("src").alias("v")).unionByName(tied.select(F.col("dst").alias("v"))).distinct()
    joined = written(_components(ids, tied), "components").select(F.col("v").alias("comp"), F.col("comp").alias("to"))
    every = f.classes.select("v").join(f.comp, "v", "left").withColumn("comp", F.coalesce("comp", "v"))
    return every.join(joined, "comp", "left").select("v", F.coalesce("to", "comp").alias("comp"))


def _known(f: Found) -> DataFrame:
    """Each class with its component's smallest doc_id."""
    c = written(f.classes.join(_tied(f), "v", "left").withColumn("comp", F.coalesce("comp", "v")), "class-components")
    least = c.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    return c.join(least, "comp").select("v", "n", "f1", "f2", F.col("doc_id").alias("class_id"), "component_id")


def _component_id():
    return F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Documents (doc_id, text) -> one row per document row: doc_id,
    n_shingles, component_id (the smallest doc_id reachable by links)."""
    f = find(docs, k, num, den)
    return (f.rows.join(_known(f).select("n", "f1", "f2", "component_id"), ["n", "f1", "f2"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"), _component_id()))


def text_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Documents (doc_id, text) -> one row per document row with words and an
    id: doc_id, h (``text_hash``), component (an arbitrary number).  Rows that
    share a doc_id are connected by their texts only."""
    f = find(docs, k, num, den)
    known = f.classes.join(f.comp, "v", "left").select("n", "f1", "f2", F.coalesce("comp", "v").alias("component"))
    return (f.rows.where("n > 0 and doc_id is not null").join(known, ["n", "f1", "f2"])
            .select("doc_id", "h", "component"))


def links(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Documents (doc_id, text) -> every link between two different sets, once:
    a_id, a_hash, b_id, b_hash, the doc_id and ``text_hash`` of the rows that
    stand for the two (the smallest doc_id with that set)."""
    f = find(docs, k, num, den)
    pairs = written(_meet(f.texts, _link_roles(f.comp, f.classes.select("v", "n"), num, den), f.classes, k, num, den, "pairs"),
                    "links")
    a = f.classes.select(F.col("v").alias("src"), F.col("doc_id").alias("a_id"), F.col("h").alias("a_hash"))
    b = f.classes.select(F.col("v").alias("dst"), F.col("doc_id").alias("b_id"), F.col("h").alias("b_hash"))
    return pairs.join(a, "src").join(b, "dst").select("a_id", "a_hash", "b_id", "b_hash")


def link_counts(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Documents (doc_id, text) -> one row per document row: doc_id,
    n_shingles, component_id, class_id (the smallest doc_id with an equal set)
    and n_links, the number of other sets that its set links with.  Counts
    leave the search, not pairs, so rows grow with the documents.  A row with
    no words or a null doc_id has no class and no links."""
    f = find(docs, k, num, den)
    found = _meet(f.texts, _link_roles(f.comp, f.classes.select("v", "n"), num, den), f.classes, k, num, den, "counts")
    n = written(found, "link-counts").groupBy(F.col("src").alias("v")).agg(F.sum("dst").alias("n_links"))
    known = _known(f).join(n, "v", "left").drop("v")
    mine = F.col("doc_id").isNotNull()
    return (f.rows.join(known, ["n", "f1", "f2"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"), _component_id(),
                    F.when(mine, F.col("class_id")).alias("class_id"),
                    F.when(mine, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links")))
