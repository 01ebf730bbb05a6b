"""Mix sources to target weights: hash-random order inside each source,
distributed prefix sums of sizes, and a cut at each source's exact budget.

Defined results: a null text has size 0; a null source is a source of its own
(ordered last); rows repeated or sharing an id are separate documents, ordered
by key, id and text digest; a source without words gets nothing; an empty
table gives no rows.  Other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import written

#: words of a document: runs of anything but ASCII white space
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, total: Column, max_epochs: float = 2.0) -> DataFrame:
    """(source, source_size, weight) -> the same with ``target``.

    ``total`` is shared by weight; a source stops at ``max_epochs`` times its
    size and what it cannot take is shared again among the rest.  The fixed
    point of that sharing is one level L with target = min(cap, weight * L):
    with sources ordered by cap / weight, L is found where the remaining total
    over the remaining weight first fits.  One row per source, so the two
    windows over all of them are small.
    """
    order = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    s = (sizes.withColumn("_cap", F.col("source_size") * F.lit(float(max_epochs)))
         .withColumn("_ratio", F.col("_cap") / F.col("weight"))
         .withColumn("_total", total.cast("double")))
    s = (s.withColumn("_level", (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
                      / F.sum("weight").over(rest))
         .withColumn("_i", F.row_number().over(order)))
    every = Window.partitionBy()
    level = F.min_by("_level", "_i").over(every)
    fits = F.when(F.col("_level") <= F.col("_ratio"), F.col("_i"))
    first = F.min(fits).over(every)
    s = s.withColumn("_first", first)
    level = F.max(F.when(F.col("_i") == F.col("_first"), F.col("_level"))).over(every)
    return s.select("source", "source_size", "weight",
                    F.least("_cap", F.coalesce(level * F.col("weight"), F.col("_cap"))).alias("target"))


def hash_key(seed: str) -> Column:
    """The random order of documents: md5 of seed and id."""
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))


def take(docs: DataFrame, goal: DataFrame, seed: str = "mix", rows_per_range: int = 4_000,
         carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, source, size, _tie, and ``carry``) and (source, source_size, target) ->
    doc_id, source, size, source_size, target, taken.

    ``floor(target)`` words are taken from each source: whole passes over it,
    then documents in the order of their hash key until the rest is used up;
    the document on the boundary is cut there.  The key space is cut in
    ranges of about ``rows_per_range`` documents; the running total of a
    document is the total of the ranges before its own plus the running total
    inside it, so a source with a third of all rows is spread over its ranges.
    """
    n = docs.count()
    bits = min(28, max(0, (n // rows_per_range).bit_length()))
    d = docs.withColumn("_key", hash_key(seed)).withColumn(
        "_range", F.shiftright(F.conv(F.substring("_key", 1, 7), 16, 10).cast("long"), 28 - bits))
    per = d.groupBy("source", "_range").agg(F.sum("size").alias("_words"))
    before = (Window.partitionBy("source").orderBy("_range")
              .rowsBetween(Window.unboundedPreceding, -1))
    per = per.withColumn("_base", F.coalesce(F.sum("_words").over(before), F.lit(0)))
    per = per.alias("p").join(goal.alias("g"), F.col("p.source").eqNullSafe(F.col("g.source"))).select(
        F.col("p.source").alias("_s"), F.col("p._range").alias("_r"), "_base", "source_size", "target")
    d = d.join(per, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_range") == F.col("_r")))
    inside = (Window.partitionBy("source", "_range").orderBy("_key", F.col("doc_id").asc_nulls_last(), "_tie")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    budget = F.floor("target")
    passes = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    left = budget - passes * F.col("source_size")
    start = F.col("_base") + F.sum("size").over(inside) - F.col("size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), left - start))
    return d.select("doc_id", "source", *carry, "size", "source_size", "target",
                    (passes * F.col("size") + part).cast("long").alias("taken"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5,
        max_epochs: float = 2.0, seed: str = "mix", texts: bool = False) -> DataFrame:
    """Documents (doc_id, text, source) -> doc_id, source, size, source_size,
    target, taken; with ``texts`` also the text.  Sources in code-point order, null last, take ``weights``
    in turn; together they share ``share`` times all words."""
    carry = ("text",) if texts else ()
    d = written(docs.select("doc_id", "source", *carry, word_count(F.col("text")).alias("size"),
                            F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("_tie")), "mix-sizes")
    sizes = d.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = F.array(*[F.lit(float(w)) for w in weights])
    sizes = sizes.withColumn("weight", F.element_at(turn, (place % len(weights) + 1).cast("int")))
    total = F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share))
    sizes = sizes.withColumn("_all", total)
    return take(d, targets(sizes, F.col("_all"), max_epochs), seed, carry=carry)


def mixed_texts(mixed: DataFrame) -> DataFrame:
    """Rows of ``mix(.., texts=True)`` that the mix takes; a document taken for
    less than its size is cut to its first ``taken`` words.  ``taken`` beyond
    the size means that the text is repeated."""
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), 1, F.col("taken").cast("int")), " ")
    return mixed.where("taken > 0").withColumn("text", F.when(F.col("taken") < F.col("size"), cut).otherwise(F.col("text")))
