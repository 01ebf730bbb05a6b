"""General table operators: summaries with missing counts, hash sampling,
top-k, flatten, set operations, partition-local pairing."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import shared_dir

from quarry.functions.expr import hash_uniform


def summary(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """count (non-missing), missing, mean, population stdev, min, max."""
    v = F.col(value)
    aggs = [F.count(v).alias("cnt"), F.count_if(v.isNull()).alias("missing"),
            F.avg(v).alias("mean"), F.stddev_pop(v).alias("stdev"),
            F.min(v).alias("min"), F.max(v).alias("max")]
    return df.groupBy(*(by or [])).agg(*aggs)


def hash_sample(df: DataFrame, fraction: float, seed: int, *key: str) -> DataFrame:
    """Bernoulli sample without replacement decided by a hash of the row key:
    the same rows in any engine and on any partitioning."""
    return df.where(hash_uniform(*[F.col(k) for k in key], F.lit(seed)) < F.lit(fraction))


def top_k(df: DataFrame, k: int, *order) -> DataFrame:
    """The first k rows in the given order (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(k)


def flatten(df: DataFrame, keep: list[str], array_col) -> DataFrame:
    return df.select(*keep, F.explode(array_col).alias("element"))


def union_distinct(*dfs: DataFrame) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out.distinct()


def consecutive_pairs(df: DataFrame, part: str, order: list[str], key: str,
                      values: list[str], schema: str, partitions: int | None = None) -> DataFrame:
    """Each row paired with the next row of the same ``part`` in ``order``
    (the explicit co-locate-and-sort form, one pass per partition with
    mapInPandas; ``order`` must be unique within a part).

    Rows are range-partitioned on (part, order) and sorted inside
    partitions, so a part holding a third of the rows spans several
    consecutive partitions instead of one task.  Pairs inside a partition
    are emitted by mapInPandas (carrying the last row across Arrow batches);
    every partition also emits its first and last row, and the pairs across
    partition boundaries come from those edge rows (two per partition).
    ``schema`` names the output: part, key, next_<key>, then each value and
    next_<value>.
    """
    from pyspark.sql import Window
    cols = list(dict.fromkeys([part, *order, key, *values]))
    n = partitions or df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    src = (df.select(*cols).repartitionByRange(int(n), part, *order)
           .sortWithinPartitions(part, *order).withColumn("_pid", F.spark_partition_id()))
    out_cols = [part, key, "next_" + key] + [c for v in values for c in (v, "next_" + v)]
    inner_schema = "_kind string, _pid int, " + schema

    def pair(batches):
        carry, first = None, None
        for pdf in batches:
            if len(pdf) == 0:
                continue
            if first is None:
                first = pdf.iloc[[0]].reset_index(drop=True)
            if carry is not None:
                pdf = pd.concat([carry, pdf], ignore_index=True)
            carry = pdf.iloc[[-1]].reset_index(drop=True)
            if len(pdf) < 2:
                continue
            p = pdf[part].to_numpy()
            same = p[:-1] == p[1:]
            out = {"_kind": "pair", "_pid": pdf["_pid"].to_numpy()[:-1][same],
                   part: p[:-1][same], key: pdf[key].to_numpy()[:-1][same],
                   "next_" + key: pdf[key].to_numpy()[1:][same]}
            for v in values:
                a = pdf[v].to_numpy()
                out[v], out["next_" + v] = a[:-1][same], a[1:][same]
            yield pd.DataFrame(out)[["_kind", "_pid"] + out_cols]
        for kind, row in (("first", first), ("last", carry)):
            if row is not None:
                e = {"_kind": kind, "_pid": row["_pid"].to_numpy(), part: row[part].to_numpy(),
                     key: row[key].to_numpy(), "next_" + key: [None]}
                for v in values:
                    e[v], e["next_" + v] = row[v].to_numpy(), [None]
                yield pd.DataFrame(e)[["_kind", "_pid"] + out_cols]

    # pairs and edges are read below: one pass, written to the shared folder
    shared_dir(df.sparkSession)
    res = src.mapInPandas(pair, inner_schema).checkpoint()
    inner = res.where(F.col("_kind") == "pair").select(*out_cols)
    # boundary pairs: last row of a partition with the first row of the next
    # non-empty partition, when both belong to the same part (edge rows: two
    # per partition, so this window is bounded by the partition count)
    edges = res.where(F.col("_kind") != "pair")
    firsts = edges.where(F.col("_kind") == "first").select(
        "_pid", *[F.col(c).alias("_f_" + c) for c in [part, key, *values]])
    w = Window.orderBy("_pid")
    nxt = firsts.select(F.col("_pid").alias("_prev"),
                        *[F.lead(F.col("_f_" + c)).over(w).alias("_n_" + c) for c in [part, key, *values]])
    lasts = edges.where(F.col("_kind") == "last").select("_pid", part, key, *values)
    cross = (lasts.join(nxt, lasts["_pid"] == nxt["_prev"])
             .where(F.col(part) == F.col("_n_" + part))
             .select(part, key, F.col("_n_" + key).alias("next_" + key),
                     *[c for v in values for c in (F.col(v), F.col("_n_" + v).alias("next_" + v))]))
    return inner.unionByName(cross)
