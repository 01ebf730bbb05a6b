"""Benchmark decontamination with a positional inverted index (DataFrame
functions only).

Postings (document, position, term) of every term that a benchmark item uses
are stored once, from one pass over the texts.  Each window of an item (10
words, or the whole of a shorter item) is searched from its rarest test term:
its postings give alignments (document, item, position shift), the window's
second rarest term, looked up at its adjusted offset, drops most of them, and
for the alignments left the postings of all item words are intersected at
their offsets.  Runs of consecutive matched words at least as long as a window
are exact phrase occurrences.  ``near_matches`` reads the same postings for
proximity: all words of a window within ``slack`` further positions.

A document is known by its id and a 64-bit hash of its text, so repeated ids
with different texts stay apart and repeated rows get equal results.

Defined results: null or empty text has no words and no hits; a null doc_id
stands for itself; items without words have no windows; repeated items, and
items whose id is repeated with other texts, count once by id (a null item_id
marks words as hit, but is not listed); empty tables give no rows, or no hits.
Other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import bounded, written

#: words of the lower-cased text: runs of anything but ASCII other than digits and a-z
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: the term that marks the end of each document; no text has it as a word
END = " "


def lower_az(c: Column) -> Column:
    """Lower-case A-Z only; a text that is all ASCII takes the quick way."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(
        F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def words(text: Column) -> Column:
    return F.regexp_extract_all(lower_az(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def item_words(items: DataFrame) -> DataFrame:
    """(item_id, text) -> (iid, item_id, i, m, word): the words of each
    distinct item; ``iid`` numbers distinct (id, text) rows."""
    d = written(items.select("item_id", "text").distinct()
                .withColumn("iid", F.monotonically_increasing_id()), "items")
    return (d.select("iid", "item_id", words(F.col("text")).alias("ws"))
            .select("iid", "item_id", F.size("ws").alias("m"), F.posexplode("ws").alias("i", "word")))


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Documents (doc_id, text) and terms (tid, word) -> the stored postings
    (doc_id, h, pos, tid).  The posting of the end mark (tid 0) stands at the
    number of words, one for each row of ``docs``."""
    t = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"),
                    F.posexplode(F.array_append(words(F.col("text")), F.lit(END))).alias("pos", "word"))
    return written(t.join(bounded(terms, 64), "word").select("doc_id", "h", "pos", "tid"), "postings")


def index_of(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(postings, item words with term ids)."""
    iw = written(item_words(items), "item-words")
    vocab = iw.select("word").distinct().withColumn("tid", F.monotonically_increasing_id() + 1)
    one = docs.sparkSession.range(1).select(F.lit(END).alias("word"), F.lit(0).cast("long").alias("tid"))
    terms = written(vocab.unionByName(one), "terms")
    return postings(docs, terms), written(iw.join(terms, "word").drop("word"), "item-terms")


def windows(post: DataFrame, iw: DataFrame, n: int) -> DataFrame:
    """The two rarest terms of each window that can occur: (iid, t1, i1, t2,
    i2).  Neighbouring windows mostly share them."""
    df = post.where("tid > 0").groupBy("tid").agg(F.count(F.lit(1)).alias("df"))
    size = F.least("m", F.lit(n))
    at = F.sequence(F.greatest(F.lit(0), F.col("i") - n + 1), F.least(F.col("i"), F.col("m") - size))
    w = (iw.join(df, "tid").withColumn("s", F.explode(at))
         .groupBy("iid", "s", "m").agg(F.sort_array(F.collect_list(F.struct("df", "tid", "i"))).alias("t"))
         .where(F.size("t") == size))
    second = F.element_at("t", F.least(F.size("t"), F.lit(2)))
    return w.select("iid", F.col("t")[0]["tid"].alias("t1"), F.col("t")[0]["i"].alias("i1"),
                    second["tid"].alias("t2"), second["i"].alias("i2")).distinct()


def alignments(post: DataFrame, wins: DataFrame) -> DataFrame:
    """(doc_id, h, iid, shift) where the two rarest words of a window stand at
    their offsets."""
    wins = written(wins, "windows")
    first = post.join(bounded(wins, 80), F.col("tid") == F.col("t1")).select(
        "doc_id", "h", "iid", (F.col("pos") - F.col("i1")).alias("shift"),
        (F.col("pos") - F.col("i1") + F.col("i2")).alias("pos2"), "t2")
    other = post.join(bounded(wins.select(F.col("t2").alias("tid")).distinct(), 32), "tid", "left_semi").select(
        F.col("doc_id").alias("d"), F.col("h").alias("dh"), F.col("pos").alias("p"), "tid")
    return (first.distinct().join(other, (F.col("doc_id").eqNullSafe(F.col("d"))) & (F.col("h") == F.col("dh"))
                                  & (F.col("pos2") == F.col("p")) & (F.col("t2") == F.col("tid")))
            .select("doc_id", "h", "iid", "shift").distinct())


def occurrences(post: DataFrame, iw: DataFrame, n: int = 10) -> DataFrame:
    """Exact phrase matches: (doc_id, h, iid, start, end), the runs of words
    of an item, at least a window long, as they stand in a document (word
    positions, end exclusive)."""
    lined = written(alignments(post, windows(post, iw, n)), "alignments")
    inside = bounded(written(lined.select("doc_id", "h").distinct(), "aligned-docs"), 24).alias("a")
    near = (post.alias("p").join(inside, F.col("p.doc_id").eqNullSafe(F.col("a.doc_id"))
                                 & (F.col("p.h") == F.col("a.h")), "left_semi")
            .select(F.col("doc_id").alias("d"), F.col("h").alias("dh"), F.col("pos").alias("p"),
                    F.col("tid").alias("t")).distinct())
    asked = lined.join(iw.select("iid", "i", "m", "tid"), "iid").withColumn("pos", F.col("shift") + F.col("i"))
    met = asked.join(near, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("dh"))
                     & (F.col("pos") == F.col("p")) & (F.col("tid") == F.col("t")))
    line = Window.partitionBy("doc_id", "h", "iid", "shift").orderBy("pos")
    run = met.withColumn("run", F.col("pos") - F.row_number().over(line))
    return (run.groupBy("doc_id", "h", "iid", "shift", "run")
            .agg(F.min("pos").alias("start"), (F.max("pos") + 1).alias("end"), F.first("m").alias("m"))
            .where(F.col("end") - F.col("start") >= F.least("m", F.lit(n)))
            .select("doc_id", "h", "iid", "start", "end"))


def scan(docs: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    """Documents (doc_id, text) and items (item_id, text) -> one row per
    document row: doc_id, n_words, n_hit, n_items, items (sorted as strings),
    contaminated, and h (the text's hash)."""
    post, iw = index_of(docs, items)
    found = written(occurrences(post, iw, n), "occurrences")
    order = Window.partitionBy("doc_id", "h").orderBy("start", "end")
    reach = F.coalesce(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    hit = (found.withColumn("new", F.greatest(F.lit(0), F.col("end") - F.greatest("start", reach)))
           .groupBy("doc_id", "h").agg(F.sum("new").alias("n_hit")))
    named = (found.select("doc_id", "h", "iid").distinct()
             .join(iw.select("iid", "item_id").distinct(), "iid")
             .groupBy("doc_id", "h").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")))
    both = hit.alias("x").join(named.alias("y"), F.col("x.doc_id").eqNullSafe(F.col("y.doc_id"))
                               & (F.col("x.h") == F.col("y.h"))).select(
        F.col("x.doc_id").alias("d"), F.col("x.h").alias("dh"), "n_hit", "items")
    ends = post.where("tid = 0").select("doc_id", "h", F.col("pos").cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    return ends.join(both, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("dh")), "left").select(
        "doc_id", "h", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), F.coalesce("items", none).alias("items"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))


def near_matches(post: DataFrame, iw: DataFrame, n: int = 10, slack: int = 3) -> DataFrame:
    """Proximity: (doc_id, h, iid, s, at) where all distinct words of window
    ``s`` stand within ``slack`` positions more than the window has, around
    the posting ``at`` of its rarest word, in any order."""
    df = post.where("tid > 0").groupBy("tid").agg(F.count(F.lit(1)).alias("df"))
    size = F.least("m", F.lit(n))
    spots = F.sequence(F.greatest(F.lit(0), F.col("i") - n + 1), F.least(F.col("i"), F.col("m") - size))
    w = (iw.join(df, "tid").withColumn("s", F.explode(spots)).groupBy("iid", "s", "m")
         .agg(F.min(F.struct("df", "tid")).alias("r"), F.collect_set("tid").alias("need"), F.count(F.lit(1)).alias("c"))
         .where(F.col("c") == size))
    w = w.select("iid", "s", "need", (F.col("c") + slack - 1).cast("int").alias("span"), F.col("r.tid").alias("tid"))
    seed = post.join(w, "tid").withColumnRenamed("pos", "at")
    want = seed.withColumn("t", F.explode("need")).withColumn("cell", F.floor(F.col("at") / 64))
    reach = n + slack - 1
    p = post.select(F.col("doc_id").alias("d"), F.col("h").alias("dh"), "pos", F.col("tid").alias("t2"))
    # a posting serves the cells of 64 positions that a window around it can begin in
    p = p.withColumn("cell2", F.explode(F.array_distinct(F.array(
        F.floor((F.col("pos") - reach) / 64), F.floor((F.col("pos") + reach) / 64)))))
    hit = want.join(p, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("dh"))
                    & (F.col("t") == F.col("t2")) & (F.col("cell") == F.col("cell2"))
                    & (F.abs(F.col("pos") - F.col("at")) <= F.col("span")))
    # a stretch of span + 1 positions holding `at` and a posting of every needed term
    starts = hit.withColumn("lo", F.explode(F.sequence(F.greatest(F.col("pos"), F.col("at")) - F.col("span"),
                                                       F.least(F.col("pos"), F.col("at")))))
    return (starts.groupBy("doc_id", "h", "iid", "s", "at", "lo")
            .agg(F.count_distinct("t").alias("got"), F.first(F.size("need")).alias("k")).where("got = k")
            .select("doc_id", "h", "iid", "s", "at").distinct())
