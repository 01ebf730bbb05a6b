"""Decision trees and random forests whose work grows with the rows, not with
nodes x bins: large nodes are split level by level from histograms, and a node
of few rows is sent, with its rows, to one task that grows its whole subtree.

Rules are those of ``pyspark.ml``'s trees: candidate thresholds, ordered and
unordered categories, gain, ties (the first feature and threshold of the best
gain), leaves, merging of sibling leaves with one prediction, votes by class
shares, Poisson weights and feature subsets per node.  A single tree comes out
as ``pyspark.ml`` makes it (while thresholds need no sample); a forest differs in
its random draws.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# tasks get these functions by value: executors need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EPSILON = 2.220446049250313e-16
#: rows of a node whose subtree one task grows: at most, at least, and the number of such nodes aimed at
MOST_ROWS, LEAST_ROWS, SUBTREES = 32768, 2048, 32
#: bytes of histograms a task holds at once
HISTOGRAMS = 64 << 20
CONTINUOUS, ORDERED, UNORDERED = 0, 1, 2


# ------------------------------------------------------------ in tasks: splits

def _impurity(counts, total, kind: str):
    """Gini or entropy of class counts (.., classes), class after class."""
    out = np.ones(total.shape) if kind == "gini" else np.zeros(total.shape)
    safe = np.where(total > 0, total, 1.0)
    for c in range(counts.shape[-1]):
        freq = counts[..., c] / safe
        if kind == "gini":
            out -= freq * freq
        else:
            out -= freq * (np.log(np.where(freq > 0, freq, 1.0)) / np.log(2))
    return np.where(total > 0, out, 0.0)


def _gains(left, total, parent, kind: str):
    """Gain of every cut; -inf where a side is empty or the gain is negative."""
    right = total - left
    n, nl, nr = total.sum(-1), left.sum(-1), right.sum(-1)
    gain = parent - (nl / n) * _impurity(left, nl, kind) - (nr / n) * _impurity(right, nr, kind)
    return np.where((nl >= 1) & (nr >= 1) & (gain >= 0), gain, -np.inf)


def _best_cuts(node, bin_, counts, totals, parent, spec: dict, f: int):
    """Best cut of feature ``f`` in each node.  ``node`` (rising), ``bin_`` and
    ``counts`` (entries, classes) hold the filled bins, ``totals`` and ``parent``
    the nodes' class counts and impurities.  Returns (gain, cut): the cut is the
    last bin to the left or, of categories, the left ones as a row of booleans."""
    k, kind, bins, imp = len(totals), spec["kinds"][f], spec["bins"][f], spec["impurity"]
    gain = np.full(k, -np.inf)
    if kind == UNORDERED:
        cells = np.zeros((k, bins, counts.shape[1]))
        cells[node, bin_] = counts
        sides = ((np.arange(1, 1 << (bins - 1))[:, None] >> np.arange(bins)) & 1).astype(bool)
        cut = np.zeros((k, bins), bool)
        step = max(1, (1 << 20) // (len(sides) * counts.shape[1]))
        for a in range(0, k, step):
            part = slice(a, min(k, a + step))
            left = np.einsum("sb,kbc->ksc", sides.astype(float), cells[part])
            g = _gains(left, totals[part, None, :], parent[part, None], imp)
            at = g.argmax(1)
            gain[part], cut[part] = g[np.arange(len(at)), at], sides[at]
        return gain, cut
    if kind == ORDERED:
        by = _impurity(counts, counts.sum(1), imp) if spec["classes"] > 2 else counts[:, -1]
        order = np.lexsort((bin_, by, node))
        bin_, counts = bin_[order], counts[order]
    cut = np.zeros((k, bins), bool) if kind == ORDERED else np.zeros(k, np.int64)
    if not len(node):
        return gain, cut
    starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    seen = node[starts]
    length = np.diff(np.r_[starts, len(node)])
    run = np.cumsum(counts, axis=0)
    run -= np.repeat(run[starts] - counts[starts], length, axis=0)
    g = _gains(run, totals[node], parent[node], imp)
    top = np.maximum.reduceat(g, starts)
    first = np.minimum.reduceat(np.where(g == np.repeat(top, length), np.arange(len(g)), len(g)), starts)
    gain[seen] = top
    if kind == CONTINUOUS:
        cut[seen] = bin_[first]
    else:
        left = np.arange(len(node)) <= np.repeat(first, length)
        cut[node[left], bin_[left]] = True
    return gain, cut


def _filled(node, bin_, label, weight, bins: int, classes: int):
    """The filled (node, bin) cells in their order, with class counts."""
    key = node * bins + bin_
    cells = (int(node.max()) + 1) * bins if len(node) else 0
    if cells <= 16 * len(key):
        have = np.bincount(key, minlength=cells) > 0
        keys, at = np.flatnonzero(have), (np.cumsum(have) - 1)[key]
    else:
        keys, at = np.unique(key, return_inverse=True)
    counts = np.bincount(at * classes + label, weight, len(keys) * classes).reshape(-1, classes)
    return keys // bins, keys % bins, counts


def _drawn(spec: dict, tree: int, ids) -> np.ndarray | None:
    """The features each node may be cut by (nodes, features), or None for all."""
    n, m = len(spec["bins"]), spec["subset"]
    if m >= n:
        return None
    keys = _hash(np.asarray(ids, np.uint64)[:, None] * np.uint64(n) + np.arange(n, dtype=np.uint64)[None, :],
                 spec["seed"] * 1000003 + tree)
    out = np.zeros((len(ids), n), bool)
    np.put_along_axis(out, np.argsort(keys, axis=1, kind="stable")[:, :m], True, axis=1)
    return out


def _hash(x, seed: int):
    """splitmix64 of integers."""
    with np.errstate(over="ignore"):
        z = x.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
        z = (z + np.uint64(0x9E3779B97F4A7C15))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def _weights(spec: dict, tree: int, row):
    """How often each row is in the tree's bag: Poisson(1) draws by row number."""
    if spec["trees"] == 1:
        return np.ones(len(row))
    u = (_hash(_hash(row, spec["seed"]), tree + 1) >> np.uint64(11)).astype(float) / float(1 << 53)
    p, steps = np.exp(-1.0), []
    total = 0.0
    for i in range(1, 25):
        total += p
        steps.append(total)
        p /= i
    return np.searchsorted(np.array(steps), u, side="right").astype(float)


# ------------------------------------------------------------- tables of nodes

class Nodes:
    """A tree as a table: children by position (leaves: feature -1), cuts,
    class counts, and the heap number of each node (root 1)."""

    def __init__(self, width: int):
        self.feature, self.cut, self.left, self.right, self.counts, self.heap = [], [], [], [], [], []
        self.masks, self.width = [], width

    def add(self, counts, heap: int) -> int:
        self.feature.append(-1)
        self.cut.append(0)
        self.left.append(-1)
        self.right.append(-1)
        self.counts.append(counts)
        self.heap.append(heap)
        return len(self.feature) - 1

    def split(self, at: int, f: int, cut, left, right) -> tuple[int, int]:
        self.feature[at] = int(f)
        if isinstance(cut, np.ndarray):
            mask = np.zeros(self.width, bool)
            mask[:len(cut)] = cut
            self.masks.append(mask)
            cut = len(self.masks) - 1
        self.cut[at] = int(cut)
        self.left[at] = self.add(left, 2 * self.heap[at])
        self.right[at] = self.add(right, 2 * self.heap[at] + 1)
        return self.left[at], self.right[at]

    def prune(self, fixed=()) -> None:
        """Sibling leaves with one prediction become their parent (``fixed``:
        leaves that stand for more)."""
        for i in range(len(self.feature) - 1, -1, -1):
            a, b = self.left[i], self.right[i]
            if self.feature[i] >= 0 and self.feature[a] < 0 and self.feature[b] < 0 and a not in fixed and b not in fixed \
                    and np.argmax(self.counts[a]) == np.argmax(self.counts[b]):
                self.feature[i] = -1

    def arrays(self) -> dict:
        """As arrays; nodes that no path reaches are left out."""
        keep, todo = [], [0]
        while todo:
            i = todo.pop()
            keep.append(i)
            if self.feature[i] >= 0:
                todo += [self.right[i], self.left[i]]
        at = {i: k for k, i in enumerate(keep)}
        inner = [i for i in keep if self.feature[i] >= 0]
        out = {"feature": np.array([self.feature[i] for i in keep], np.int32),
               "cut": np.array([self.cut[i] for i in keep], np.int32),
               "left": np.full(len(keep), -1, np.int32), "right": np.full(len(keep), -1, np.int32),
               "counts": np.array([self.counts[i] for i in keep], float),
               "masks": np.array(self.masks, bool).reshape(-1, self.width),
               "heap": np.array([self.heap[i] for i in keep], np.int64)}
        for i in inner:
            out["left"][at[i]], out["right"][at[i]] = at[self.left[i]], at[self.right[i]]
        return out


def _walk(t: dict, bins, kinds):
    """Position of the leaf of every row of bins."""
    at = np.zeros(len(bins), np.int64)
    rows = np.arange(len(bins))
    while True:
        rows = rows[t["feature"][at[rows]] >= 0]
        if not len(rows):
            return at
        node = at[rows]
        f = t["feature"][node]
        b = bins[rows, f].astype(np.int64)
        left = b <= t["cut"][node]
        flags = np.flatnonzero(kinds[f] != CONTINUOUS)
        if len(flags):
            left[flags] = t["masks"][t["cut"][node[flags]], b[flags]]
        at[rows] = np.where(left, t["left"][node], t["right"][node])


def _is_leaf(counts, heap: int, spec: dict) -> bool:
    """Whether a new node is a leaf: at the greatest depth, or pure."""
    counts = np.asarray(counts)
    return heap.bit_length() - 1 >= spec["depth"] or \
        abs(float(_impurity(counts, counts.sum(), spec["impurity"]))) < EPSILON


def _grow(bins, label, weight, spec: dict, tree: int, heap: int) -> Nodes:
    """The subtree of a node from its rows, level by level."""
    classes, kinds = spec["classes"], spec["kinds"]
    nodes = Nodes(spec["width"])
    nodes.add(np.bincount(label, weight, classes).astype(float), heap)
    slot = np.zeros(len(label), np.int64)          # place in the level of each row's node
    level = [] if _is_leaf(nodes.counts[0], heap, spec) else [0]
    if not level:
        return nodes
    while level:
        k = len(level)
        totals = np.bincount(slot * classes + label, weight, k * classes).reshape(k, classes)
        parent = _impurity(totals, totals.sum(1), spec["impurity"])
        use = _drawn(spec, tree, [nodes.heap[i] for i in level])
        best, by = np.full(k, -np.inf), np.full(k, -1)
        limit, sides = np.full(k, -1), np.zeros((k, spec["width"]), bool)   # cuts of values; of categories
        for f in range(len(kinds)):
            if spec["bins"][f] < 2:
                continue
            rows = slice(None) if use is None else np.flatnonzero(use[slot, f])
            s = slot[rows]
            if not len(s):
                continue
            node, bin_, counts = _filled(s, bins[rows, f].astype(np.int64), label[rows], weight[rows],
                                         spec["bins"][f], classes)
            gain, cut = _best_cuts(node, bin_, counts, totals, parent, spec, f)
            better = np.flatnonzero(gain > best)
            best[better], by[better] = gain[better], f
            if kinds[f] == CONTINUOUS:
                limit[better] = cut[better]
            else:
                sides[better, :spec["bins"][f]] = cut[better]
                sides[better, spec["bins"][f]:] = False
        # rows go to the children
        going = np.flatnonzero(best[slot] > 0)
        s, f = slot[going], by[slot[going]]
        b = bins[going, f].astype(np.int64)
        left = b <= limit[s]
        flags = np.flatnonzero(kinds[f] != CONTINUOUS)
        if len(flags):
            left[flags] = sides[s[flags], b[flags]]
        child = s * 2 + np.where(left, 0, 1)
        sums = np.bincount(child * classes + label[going], weight[going], 2 * k * classes).reshape(k, 2, classes)
        next_level, place = [], np.full(2 * k, -1)
        for i in np.flatnonzero(best > 0):
            cut = limit[i] if kinds[by[i]] == CONTINUOUS else sides[i]
            for side, at in enumerate(nodes.split(level[i], by[i], cut, sums[i, 0], sums[i, 1])):
                if not _is_leaf(sums[i, side], nodes.heap[at], spec):
                    place[2 * i + side] = len(next_level)
                    next_level.append(at)
        on = place[child] >= 0
        keep = going[on]
        bins, label, weight, slot = bins[keep], label[keep], weight[keep], place[child[on]]
        level = next_level
    return nodes


# ------------------------------------------------------------ in tasks: batches

def _unpack(column, width: int):
    """A column of packed bins as (rows, features)."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, width)


def _to_bins(spec: dict, keep: list[str]):
    """Values -> packed bins: the number of thresholds below a value, or a
    category's index."""
    def run(batches):
        width = len(spec["bins"])
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(batch.schema.get_field_index("_x")).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            out = np.empty(x.shape, np.uint16)
            for f in range(width):
                out[:, f] = (np.searchsorted(spec["thresholds"][f], x[:, f], side="left")
                             if spec["kinds"][f] == CONTINUOUS else x[:, f])
            packed = pa.array([row.tobytes() for row in out], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in keep] + [packed],
                                             names=[*keep, "_bins"])
    return run


def _columns(width: int):
    """Each batch's values by feature."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(width), pa.int32()), pa.array(list(np.ascontiguousarray(x.T)), pa.list_(pa.float64()))],
                    names=["f", "x"])
    return run


def _thresholds(most: int):
    """A feature's thresholds: midpoints of all neighbours, or where the counts
    come closest to equal strides."""
    def run(group):
        x = group.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        values, counts = np.unique(x, return_counts=True)
        if len(values) - 1 <= most - 1:
            cuts = (values[:-1] + values[1:]) / 2.0
        else:
            stride = len(x) / float(most)
            cuts, target, now = [], stride, float(counts[0])
            for i in range(1, len(values)):
                before, now = now, now + float(counts[i])
                if abs(before - target) < abs(now - target):
                    cuts.append((values[i - 1] + values[i]) / 2.0)
                    target += stride
        return pa.table({"f": pa.array([group.column("f")[0].as_py()], pa.int32()),
                         "cuts": pa.array([np.asarray(cuts, float)], pa.list_(pa.float64()))})
    return run


def _histograms(spec: dict, tops: list[dict], open_: dict):
    """Class counts (features, bins) of the open nodes' rows in a partition.
    ``open_``: (tree, position) -> heap number."""
    def run(batches):
        width, classes = len(spec["bins"]), spec["classes"]
        trees = sorted({t for t, _ in open_})
        use = {key: _drawn(spec, key[0], [heap]) for key, heap in open_.items()}
        held = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            bins = _unpack(batch.column(batch.schema.get_field_index("_bins")), width)
            label = batch.column(batch.schema.get_field_index("_label")).to_numpy(zero_copy_only=False).astype(np.int64)
            row = batch.column(batch.schema.get_field_index("_row")).to_numpy(zero_copy_only=False)
            for t in trees:
                weight = _weights(spec, t, row)
                at = _walk(tops[t], bins, spec["kinds"])
                for key in open_:
                    if key[0] != t:
                        continue
                    rows = np.flatnonzero((at == key[1]) & (weight > 0))
                    if not len(rows):
                        continue
                    for f in range(width):
                        if spec["bins"][f] < 2 or (use[key] is not None and not use[key][0, f]):
                            continue
                        size = spec["bins"][f] * classes
                        got = np.bincount(bins[rows, f].astype(np.int64) * classes + label[rows], weight[rows], size)
                        old = held.get((*key, f))
                        held[(*key, f)] = got if old is None else old + got
        for (t, node, f), counts in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([t], pa.int32()), pa.array([node], pa.int32()), pa.array([f], pa.int32()),
                 pa.array([counts.astype(np.int32).tobytes()], pa.binary())], names=["tree", "node", "f", "counts"])
    return run


def _cut_of(spec: dict):
    """A node's best cut by one feature, from the partitions' histograms."""
    def run(group):
        f, classes = group.column("f")[0].as_py(), spec["classes"]
        counts = np.sum([np.frombuffer(c, np.int32).astype(float) for c in group.column("counts").to_pylist()], axis=0)
        counts = counts.reshape(-1, classes)
        total = counts.sum(0, keepdims=True)
        bin_ = np.flatnonzero(counts.sum(1) > 0)
        gain, cut = _best_cuts(np.zeros(len(bin_), np.int64), bin_, counts[bin_], total,
                               _impurity(total, total.sum(1), spec["impurity"]), spec, f)
        side = cut[0] if spec["kinds"][f] != CONTINUOUS else np.arange(len(counts)) <= cut[0]
        return pa.table({"tree": group.column("tree")[:1], "node": group.column("node")[:1], "f": group.column("f")[:1],
                         "gain": pa.array([float(gain[0])]), "side": pa.array([side.tobytes()], pa.binary()),
                         "left": pa.array([counts[side].sum(0)], pa.list_(pa.float64())),
                         "right": pa.array([counts[~side].sum(0)], pa.list_(pa.float64()))})
    return run


def _routed(spec: dict, tops: list[dict], keep: list[str], fit: bool, subs: set):
    """Every row of every tree with the node where the top of the tree leaves
    it: to a subtree (``subs``: (tree, position)), or with a leaf's shares."""
    def run(batches):
        width = len(spec["bins"])
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(batch.schema.get_field_index("_bins"))
            bins = _unpack(column, width)
            for t, top in enumerate(tops):
                at = _walk(top, bins, spec["kinds"])
                inside = np.isin(at, [n for tree, n in subs if tree == t])
                if fit:
                    row = batch.column(batch.schema.get_field_index("_row")).to_numpy(zero_copy_only=False)
                    weight = _weights(spec, t, row)
                    rows = np.flatnonzero(inside & (weight > 0))
                    extra = [pa.array(weight[rows])]
                else:
                    rows = np.arange(len(at))
                    share = top["counts"] / np.maximum(top["counts"].sum(1, keepdims=True), 1.0)
                    extra = [pa.array([None if i else share[a] for i, a in zip(inside, at)], pa.list_(pa.float64()))]
                if not len(rows):
                    continue
                part = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(c)) for c in keep]
                    + [pa.array(np.full(len(rows), t), pa.int32()), pa.array(at[rows], pa.int32())] + extra,
                    names=[*keep, "_tree", "_node", "_w" if fit else "_votes"])
    return run


PARTS = [("feature", np.int32), ("cut", np.int32), ("left", np.int32), ("right", np.int32), ("counts", float), ("masks", bool)]


def _subtree(spec: dict, heaps: dict):
    """The rows of a node -> its subtree, as one row."""
    def run(group):
        key = (group.column("_tree")[0].as_py(), group.column("_node")[0].as_py())
        nodes = _grow(_unpack(group.column("_bins"), len(spec["bins"])),
                      group.column("_label").to_numpy().astype(np.int64), group.column("_w").to_numpy(),
                      spec, key[0], heaps[key])
        nodes.prune()
        t = nodes.arrays()
        return pa.table({"_tree": pa.array([key[0]], pa.int32()), "_node": pa.array([key[1]], pa.int32()),
                         "leaf": pa.array([bool(t["feature"][0] < 0)]),
                         **{name: pa.array([np.ascontiguousarray(t[name]).astype(kind).tobytes()], pa.binary())
                            for name, kind in PARTS}})
    return run


def _vote(spec: dict, keep: list[str]):
    """Rows and their subtree -> the shares of the leaf each row reaches."""
    def run(rows, subtree):
        t = {name: np.frombuffer(subtree.column(name)[0].as_py(), kind) for name, kind in PARTS} if subtree.num_rows else None
        share = []
        if rows.num_rows:
            t["counts"], t["masks"] = t["counts"].reshape(-1, spec["classes"]), t["masks"].reshape(-1, spec["width"])
            at = _walk(t, _unpack(rows.column("_bins"), len(spec["bins"])), spec["kinds"])
            got = t["counts"][at]
            share = list(got / got.sum(1, keepdims=True))
        return pa.table([rows.column(c) for c in keep] + [pa.array(share, pa.list_(pa.float64()))], names=[*keep, "_votes"])
    return run


# ---------------------------------------------------------------- on the driver

class TreeClassifier:
    """Estimator of a tree (``trees`` = 1) or a forest (sqrt of the features at
    each node, Poisson bags).  ``fit`` takes ``features`` (vectors; categories as
    its ML attributes name them) and ``label`` (0, 1, ..)."""

    def __init__(self, impurity: str, depth: int, bins: int, seed: int, trees: int = 1):
        self.impurity, self.depth, self.bins, self.seed, self.trees = impurity, depth, bins, seed, trees

    def _spec(self, df: DataFrame, x: DataFrame) -> tuple[dict, int]:
        n, classes, width = x.agg(F.count(F.lit(1)), F.max("_label"), F.max(F.size("_x"))).first()
        if not n:
            raise ValueError("no rows to fit a tree on")
        most = min(self.bins, n)
        attrs = df.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
        categories = {a["idx"]: len(a["vals"]) for a in attrs.get("nominal", [])}
        categories.update({a["idx"]: 2 for a in attrs.get("binary", [])})
        classes = max(int(classes) + 1, 2)
        unordered = int(np.log(most // 2 + 1) / np.log(2) + 1) if classes > 2 else 0
        # thresholds come from as many rows as pyspark.ml takes for them, all unless there are more
        need = max(self.bins * self.bins, 10000)
        some = x if need >= n else x.sample(False, need / n, self.seed)
        cuts = (some.select("_x").mapInArrow(_columns(width), "f int, x array<double>").groupBy("f")
                .applyInArrow(_thresholds(most), "f int, cuts array<double>"))
        thresholds = {r["f"]: np.array(r["cuts"], float) for r in cuts.collect()}  # at most bins a feature
        kinds, sizes = [], []
        for f in range(width):
            arity = categories.get(f)
            if arity is None:
                kinds.append(CONTINUOUS)
                sizes.append(len(thresholds[f]) + 1)
                continue
            if arity > most:
                raise ValueError(f"feature {f} has {arity} categories, more than {most} bins")
            kinds.append(UNORDERED if arity <= unordered else ORDERED)
            sizes.append(arity)
        subset = int(np.ceil(np.sqrt(width))) if self.trees > 1 else width
        return {"impurity": self.impurity, "depth": self.depth, "seed": self.seed, "trees": self.trees,
                "classes": classes, "kinds": np.array(kinds), "bins": sizes, "subset": subset,
                "width": max([2] + [s for s, kind in zip(sizes, kinds) if kind != CONTINUOUS]),
                "thresholds": [thresholds.get(f, np.array([])) for f in range(width)]}, n

    def fit(self, df: DataFrame) -> "TreeModel":
        from quarry.session import shared_dir
        spark = df.sparkSession
        shared_dir(spark)
        x = df.select(F.col("label").cast("int").alias("_label"), vector_to_array("features").alias("_x"))
        spec, n = self._spec(df, x)
        rows = (x.mapInArrow(_to_bins(spec, ["_label"]), "_label int, _bins binary")
                .withColumn("_row", F.monotonically_increasing_id()).checkpoint())
        few = int(min(MOST_ROWS, max(LEAST_ROWS, n * self.trees // (2 * SUBTREES if self.trees > 1 else SUBTREES))))
        tops = [Nodes(spec["width"]) for _ in range(self.trees)]
        for t in tops:
            t.add(np.zeros(spec["classes"]), 1)
        # the root is open unless all rows go to one subtree; afterwards a node's counts say which it is
        open_ = {(t, 0): 1 for t in range(self.trees)} if n > few and self.depth > 0 else {}
        subs = {} if open_ else {(t, 0): 1 for t in range(self.trees)}
        while open_:
            drawn = min(spec["subset"], len(spec["kinds"])) * max(spec["bins"]) * spec["classes"] * 8
            at_once = max(1, HISTOGRAMS // drawn)
            keys, got = list(open_), []
            arrays = [self._top(t) for t in tops]
            for a in range(0, len(keys), at_once):
                part = {key: open_[key] for key in keys[a:a + at_once]}
                got += (rows.mapInArrow(_histograms(spec, arrays, part), "tree int, node int, f int, counts binary")
                        .groupBy("tree", "node", "f").applyInArrow(
                            _cut_of(spec), "tree int, node int, f int, gain double, side binary, left array<double>, right array<double>")
                        .collect())  # a row for each open node and feature
            best = {}
            for r in sorted(got, key=lambda r: r["f"]):
                key = (r["tree"], r["node"])
                if key not in best or r["gain"] > best[key]["gain"]:
                    best[key] = r
            open_ = {}
            for (t, node), r in sorted(best.items()):
                top, left, right = tops[t], np.array(r["left"]), np.array(r["right"])
                top.counts[node] = left + right
                if not r["gain"] > 0 or _is_leaf(top.counts[node], top.heap[node], spec):
                    continue
                side = np.frombuffer(r["side"], bool)
                cut = side if spec["kinds"][r["f"]] != CONTINUOUS else int(side.sum()) - 1
                for at, counts in zip(top.split(node, r["f"], cut, left, right), (left, right)):
                    if not _is_leaf(counts, top.heap[at], spec):
                        (open_ if counts.sum() > few else subs)[(t, at)] = top.heap[at]
        arrays = [self._top(t) for t in tops]
        made = (rows.mapInArrow(_routed(spec, arrays, ["_label", "_bins"], True, set(subs)),
                                "_label int, _bins binary, _tree int, _node int, _w double")
                .groupBy("_tree", "_node").applyInArrow(
                    _subtree(spec, subs), "_tree int, _node int, leaf boolean, " + ", ".join(f"{p} binary" for p, _ in PARTS))
                .checkpoint())
        # a subtree that came out as one leaf is a leaf of the top, and may merge with its sibling
        for r in made.where("leaf").select("_tree", "_node", "counts").collect():
            tops[r["_tree"]].counts[r["_node"]] = np.frombuffer(r["counts"], float)
            subs.pop((r["_tree"], r["_node"]))
        for t, top in enumerate(tops):
            top.prune({node for tree, node in subs if tree == t})
        return TreeModel(spec, [self._top(t) for t in tops], set(subs), made.where(~F.col("leaf")))

    @staticmethod
    def _top(nodes: Nodes) -> dict:
        """The top of a tree by the positions in which it was made."""
        return {"feature": np.array(nodes.feature, np.int32), "cut": np.array(nodes.cut, np.int32),
                "left": np.array(nodes.left, np.int32), "right": np.array(nodes.right, np.int32),
                "counts": np.array(nodes.counts, float), "masks": np.array(nodes.masks, bool).reshape(-1, nodes.width)}


class TreeModel:
    """Fitted trees: their tops, and a table of subtrees."""

    def __init__(self, spec: dict, tops: list[dict], subs: set, subtrees: DataFrame):
        self.spec, self.tops, self.subs, self.subtrees = spec, tops, subs, subtrees

    def transform(self, df: DataFrame) -> DataFrame:
        """The columns of ``df`` but ``features``, and ``prediction``: the class
        of the largest sum of the trees' leaf shares (ties: the smaller class).
        Rows meet the subtree they fall into; a subtree that more rows than
        MOST_ROWS fall into goes to several tasks."""
        spec, several = self.spec, len(self.tops) > 1
        plain = df.select(*[c for c in df.columns if c != "features"], vector_to_array("features").alias("_x"))
        fields = [f for f in plain.schema if f.name != "_x"]
        cols = [f.name for f in fields]
        bins = T.StructField("_bins", T.BinaryType())
        x = plain.mapInArrow(_to_bins(spec, cols), T.StructType([*fields, bins]))
        if several:   # rows are put together again by number, so the numbers must stay
            x = x.withColumn("_row", F.monotonically_increasing_id()).checkpoint()
            row = T.StructField("_row", T.LongType())
            base, fields, cols = x.select(*cols, "_row"), [row], ["_row"]
        votes = T.StructField("_votes", T.ArrayType(T.DoubleType()))
        place = [T.StructField("_tree", T.IntegerType()), T.StructField("_node", T.IntegerType())]
        at = (x.select(*cols, "_bins").mapInArrow(_routed(spec, self.tops, [*cols, "_bins"], False, self.subs),
                                                  T.StructType([*fields, bins, *place, votes])).checkpoint())
        out = at.where(F.col("_votes").isNotNull()).select(*cols, "_votes")
        if self.subs:
            inner = at.where(F.col("_votes").isNull()).drop("_votes")
            # a row for each subtree; several shares where many rows fall into it
            shares = (inner.groupBy("_tree", "_node").agg(F.ceil(F.count(F.lit(1)) / F.lit(MOST_ROWS)).cast("int").alias("_of"))
                      .checkpoint())
            spread = (inner.join(F.broadcast(shares), ["_tree", "_node"])
                      .withColumn("_share", F.pmod(F.monotonically_increasing_id(), F.col("_of")).cast("int")).drop("_of"))
            trees = (self.subtrees.join(F.broadcast(shares), ["_tree", "_node"])
                     .withColumn("_share", F.explode(F.sequence(F.lit(0), F.col("_of") - 1))).drop("_of"))
            key = ["_tree", "_node", "_share"]
            out = out.unionByName(spread.groupBy(*key).cogroup(trees.groupBy(*key))
                                  .applyInArrow(_vote(spec, cols), T.StructType([*fields, votes])))
        if several:
            sums = F.array(*[F.sum(F.get("_votes", F.lit(c))) for c in range(spec["classes"])])
            out = base.join(out.groupBy("_row").agg(sums.alias("_votes")), "_row").drop("_row")
        return out.withColumn("prediction", (F.array_position("_votes", F.array_max("_votes")) - 1).cast("double")).drop("_votes")
