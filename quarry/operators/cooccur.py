"""Co-occurrence of items in baskets: frequencies, pairs, chi-square edges.

A basket is a group id with items (citation -> topics, order -> part names).
Pairs are counted over *distinct* items per basket, so a repeated item never
forms a self-pair or inflates a count; plain frequencies keep multiplicity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.expr import chi_square, hash8

# Items per salt bucket when a basket is split across tasks.
PAIR_CHUNK = 1024


def item_frequency(items: DataFrame, item: str = "topic") -> DataFrame:
    """``select item, count(*) cnt group by item`` (multiplicity kept)."""
    return items.groupBy(item).agg(F.count(F.lit(1)).alias("cnt"))


def frequency_of_frequency(freq: DataFrame, cnt: str = "cnt") -> DataFrame:
    """How many items occur exactly ``cnt`` times."""
    return freq.groupBy(cnt).agg(F.count(F.lit(1)).alias("dist"))


def distinct_baskets(items: DataFrame, basket: str, item: str) -> DataFrame:
    """Distinct (basket, item) rows; NULL items dropped.  Partial aggregation
    runs map-side, so a basket with many copies of an item shrinks before the
    shuffle."""
    return (items.select(F.col(basket).alias("basket"), F.col(item).alias("item"))
            .where(F.col("item").isNotNull())
            .distinct())


def pairs_within(dist: DataFrame, chunk: int = PAIR_CHUNK) -> DataFrame:
    """All item pairs a < b sharing a basket, from distinct (basket, item) rows.

    Skew: a basket with n distinct items yields n(n-1)/2 pairs.  To keep a hot
    basket from landing in one task, its left side is split into
    ceil(n / chunk) salt buckets and its right side replicated into each bucket;
    baskets with n <= chunk get one bucket and are not replicated.  The join key
    is (basket, salt), so the split buckets go to different tasks.
    """
    # basket sizes by aggregation (partial counts map-side), joined back: no
    # window buffers a hot basket in one task
    sizes = dist.groupBy("basket").agg(F.count(F.lit(1)).alias("n"))
    sized = dist.join(sizes, "basket")
    nsalt = F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(chunk))).cast("int")
    left = sized.select("basket", F.col("item").alias("a"),
                        F.pmod(F.xxhash64("item"), nsalt).cast("int").alias("salt"))
    right = sized.select("basket", F.col("item").alias("b"),
                         F.explode(F.sequence(F.lit(0), nsalt - 1)).alias("salt"))
    return (left.join(right, ["basket", "salt"])
            .where(F.col("a") < F.col("b"))
            .select("basket", "a", "b"))


def pair_counts(dist: DataFrame, chunk: int = PAIR_CHUNK) -> DataFrame:
    """(topic_a, topic_b, cnt): baskets holding both; topic_a < topic_b."""
    return (pairs_within(dist, chunk)
            .groupBy(F.col("a").alias("topic_a"), F.col("b").alias("topic_b"))
            .agg(F.count(F.lit(1)).alias("cnt")))


def basket_margins(dist: DataFrame) -> DataFrame:
    """Baskets containing each item: (item, n_baskets)."""
    return dist.groupBy("item").agg(F.count(F.lit(1)).alias("n_baskets"))


def chi_square_edges(dist: DataFrame, total, threshold: float | None = None,
                     chunk: int = PAIR_CHUNK) -> DataFrame:
    """Chi-square (Yates) of every co-occurring pair.

    ``total`` is the number of baskets (a Column, e.g. a scalar subquery, or a
    number): baskets without items count too, as in the citation corpus.
    Output: topic_a, topic_b, src, dst (8-hex md5 ids, src <= dst), cnt,
    ya, yb, chisquare; filtered to chisquare > threshold when given.
    """
    pc = pair_counts(dist, chunk)
    m = basket_margins(dist)
    ma = m.select(F.col("item").alias("topic_a"), F.col("n_baskets").alias("ya"))
    mb = m.select(F.col("item").alias("topic_b"), F.col("n_baskets").alias("yb"))
    t = total if not isinstance(total, (int, float)) else F.lit(total)
    out = (pc.join(ma, "topic_a").join(mb, "topic_b")
           .withColumn("chisquare", chi_square("cnt", "yb", "ya", t)))
    ha, hb = hash8("topic_a"), hash8("topic_b")
    out = out.select("topic_a", "topic_b",
                     F.least(ha, hb).alias("src"), F.greatest(ha, hb).alias("dst"),
                     "cnt", "ya", "yb", "chisquare")
    if threshold is not None:
        out = out.where(F.col("chisquare") > F.lit(threshold))
    return out


def vertex_ids(items: DataFrame, item: str = "topic") -> DataFrame:
    """Vertices (id = 8-hex md5 of the topic, topic), deduplicated."""
    return items.select(hash8(item).alias("id"), F.col(item).alias("topic")).dropDuplicates()


def hash_collision_check(items: DataFrame, item: str = "topic") -> DataFrame:
    """count(distinct topic) vs count(distinct id): equal when md5[:8] has no collision."""
    return items.agg(F.count_distinct(item).alias("unique_topics"),
                     F.count_distinct(hash8(item)).alias("unique_hashids"))


def major_topics(citations: DataFrame, id_col: str = "PMID") -> DataFrame:
    """(id, topic) for every DescriptorName marked MajorTopicYN = 'Y'."""
    heads = F.filter(F.col("MeshHeadingList.MeshHeading"),
                     lambda h: h["DescriptorName"]["_MajorTopicYN"] == "Y")
    names = F.transform(heads, lambda h: h["DescriptorName"]["_VALUE"])
    return citations.select(F.col(id_col).alias("basket"), F.explode(names).alias("topic"))
