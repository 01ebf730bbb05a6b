"""Record linkage: per-field agreement statistics with missing values, and
Fellegi-Sunter match weights.

Candidate pairs are all record pairs inside a block (same blocking key); a pair
is *matched* when the two records share the label.  A pair's score on a field
is 1 when both values are present and equal, 0 when both are present and
differ, and missing otherwise.

Nothing here materialises pairs.  Every statistic over the pairs of a block is
a sum of binomials of value counts, e.g. the matched pairs agreeing on a field
are sum over (block, label, value) of C(n, 2).  So the work is a few
aggregations over the records (partial aggregation map-side), linear in the
input however large a block is; the pair count of a block can be quadratic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _c2(c) -> F.Column:
    """C(n, 2), exact also beyond 2^53: the even one of n and n - 1 is halved
    as a long, the product is a decimal."""
    n = c.cast("long")
    even = F.when(n % 2 == 0, n).otherwise(n - 1)
    odd = F.when(n % 2 == 0, n - 1).otherwise(n)
    return F.shiftright(even, 1).cast("decimal(18,0)") * odd.cast("decimal(18,0)")


def to_long(records: DataFrame, block: str, label: str, fields: list[str]) -> DataFrame:
    """(block, label, field, value) with values as strings (compared exactly)."""
    cols = [F.col(f).cast("string").alias(f) for f in fields]
    w = records.select(F.col(block).alias("block"), F.col(label).alias("label"), *cols)
    return w.unpivot(["block", "label"], fields, "field", "value")


def pair_field_counts(records: DataFrame, block: str, label: str,
                      fields: list[str]) -> DataFrame:
    """Per (field, matched): pairs, pairs with both values present, agreeing pairs.

    Output columns: field, matched, pairs, nonnull, agree (exact decimals).
    """
    from quarry.session import shared_dir
    shared_dir(records.sparkSession)   # checkpoint() below needs the shared folder
    long = to_long(records, block, label, fields)
    # One pass over the records: value counts per (field, block, label, value),
    # NULL values included, written once; every sum below reads this table.
    bsv_all = (long.groupBy("field", "block", "label", "value")
               .agg(F.count(F.lit(1)).alias("c")).checkpoint())
    bsv = bsv_all.where(F.col("value").isNotNull())
    # matched side: same block and label
    bs = bsv.groupBy("field", "block", "label").agg(
        F.sum("c").alias("nn"), F.sum(_c2(F.col("c"))).alias("agree"))
    m = bs.groupBy("field").agg(F.sum(_c2(F.col("nn"))).alias("nonnull_m"),
                                F.sum("agree").alias("agree_m"))
    # all pairs of a block, matched or not
    bv = bsv.groupBy("field", "block", "value").agg(F.sum("c").alias("c"))
    a_all = bv.groupBy("field").agg(F.sum(_c2(F.col("c"))).alias("agree_all"))
    nn_all = (bs.groupBy("field", "block").agg(F.sum("nn").alias("nn"))
              .groupBy("field").agg(F.sum(_c2(F.col("nn"))).alias("nonnull_all")))
    # total pairs do not depend on the field: block sizes from any one field's
    # counts (NULLs included), as two scalar subqueries
    sizes = (bsv_all.where(F.col("field") == fields[0])
             .groupBy("block", "label").agg(F.sum("c").alias("n")))
    p_m = sizes.select(F.sum(_c2(F.col("n")))).scalar()
    p_all = (sizes.groupBy("block").agg(F.sum("n").alias("n"))
             .select(F.sum(_c2(F.col("n")))).scalar())
    per_field = (F.broadcast(records.sparkSession.createDataFrame([(f,) for f in fields], "field string"))
                 .join(m, "field", "left").join(a_all, "field", "left").join(nn_all, "field", "left")
                 .withColumns({c: F.coalesce(F.col(c), F.lit(0).cast("decimal(38,0)"))
                               for c in ("nonnull_m", "agree_m", "agree_all", "nonnull_all")}))
    matched = per_field.select("field", F.lit(True).alias("matched"), p_m.alias("pairs"),
                               F.col("nonnull_m").alias("nonnull"), F.col("agree_m").alias("agree"))
    unmatched = per_field.select("field", F.lit(False).alias("matched"), (p_all - p_m).alias("pairs"),
                                 (F.col("nonnull_all") - F.col("nonnull_m")).alias("nonnull"),
                                 (F.col("agree_all") - F.col("agree_m")).alias("agree"))
    return matched.unionByName(unmatched)


def missing_stats(counts: DataFrame) -> DataFrame:
    """Summary of each field's 0/1 score over the pairs, missing counted apart:
    cnt, missing, mean, stdev (population), min, max."""
    nn, ag = F.col("nonnull"), F.col("agree")
    mean = ag.cast("double") / F.nullif(nn.cast("double"), F.lit(0.0))
    return counts.select(
        "matched", "field",
        nn.cast("long").alias("cnt"),
        (F.col("pairs") - nn).cast("long").alias("missing"),
        mean.alias("mean"),
        F.sqrt(F.greatest(mean * (F.lit(1.0) - mean), F.lit(0.0))).alias("stdev"),
        F.when(nn > 0, F.when(nn - ag > 0, 0.0).otherwise(1.0)).alias("min"),
        F.when(nn > 0, F.when(ag > 0, 1.0).otherwise(0.0)).alias("max"))


def match_counts(counts: DataFrame) -> DataFrame:
    """Number of candidate pairs per matched flag."""
    return counts.groupBy("matched").agg(F.max("pairs").cast("long").alias("cnt"))


def value_frequencies(records: DataFrame, fields: list[str]) -> DataFrame:
    """u per field: chance agreement sum of p(v)^2, p over all records.
    One wide row (a column per field), like a frequencies file."""
    n = records.select(F.count(F.lit(1)).cast("double")).scalar()
    long = to_long(records.withColumn("_b", F.lit(0)).withColumn("_l", F.lit(0)), "_b", "_l", fields)
    u = (long.where(F.col("value").isNotNull())
         .groupBy("field", "value").agg(F.count(F.lit(1)).alias("c"))
         .groupBy("field").agg(F.sum((F.col("c") / n) * (F.col("c") / n)).alias("u")))
    return u.groupBy().pivot("field", fields).agg(F.first("u"))


def match_weights(counts: DataFrame, u_long: DataFrame) -> DataFrame:
    """Fellegi-Sunter weights per field (missing score = disagreement).

    m = agreeing matched pairs / matched pairs; u from the frequencies table.
    Agreement: ratio m/u and weight log2(m/u); disagreement: (1-m)/(1-u) and
    its log2.  Undefined (m or u at 0 or 1, or no matched pairs) -> NULL.
    """
    m = (counts.where(F.col("matched"))
         .select("field", (F.col("agree").cast("double") / F.nullif(F.col("pairs").cast("double"), F.lit(0.0))).alias("m")))
    x = m.join(u_long, "field")
    mm, uu = F.col("m"), F.col("u")
    ok = (mm > 0) & (mm < 1) & (uu > 0) & (uu < 1)
    r1 = mm / uu
    r0 = (F.lit(1.0) - mm) / (F.lit(1.0) - uu)
    return x.select("field", "m", "u",
                    F.when(ok, r1).alias("match_ratio"), F.when(ok, F.log2(r1)).alias("match_weight"),
                    F.when(ok, r0).alias("nonmatch_ratio"), F.when(ok, F.log2(r0)).alias("nonmatch_weight"))


# ------------------------------------------------------------ scored pairs

def score_stats(pairs: DataFrame) -> DataFrame:
    """Per (matched, score position): count (present), missing, mean, stdev
    (population), min, max - over given record pairs (id1, id2, scores array,
    matched).  One pass: posexplode + a partial/final aggregation."""
    x = pairs.select("matched", F.posexplode("scores").alias("pos", "s"))
    s = F.col("s")
    return x.groupBy("matched", "pos").agg(
        F.count(s).alias("cnt"), F.count_if(s.isNull()).alias("missing"), F.avg(s).alias("mean"),
        F.stddev_pop(s).alias("stdev"), F.min(s).alias("min"), F.max(s).alias("max"))


def weights_from_scores(pairs: DataFrame, freq: DataFrame) -> DataFrame:
    """Fellegi-Sunter weights from given pairs: m = share of matched pairs
    whose score is exactly 1 (a missing score counts as disagreement); u from
    the frequencies table (pos, field, u), aligned with the score positions."""
    m = (pairs.where(F.col("matched")).select(F.posexplode("scores").alias("pos", "s"))
         .groupBy("pos").agg(F.count(F.lit(1)).cast("double").alias("pairs"),
                             F.sum(F.when(F.col("s") == 1.0, 1.0).otherwise(0.0)).alias("agree")))
    counts = m.join(freq.select("pos", "field"), "pos").select(
        "field", F.lit(True).alias("matched"), "pairs", "agree")
    return match_weights(counts, freq.select("field", "u"))
