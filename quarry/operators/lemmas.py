"""Lemmas of a corpus's words: a dictionary of forms, and for words it lacks
the longest suffix that a rule names.

Work is done once per distinct (lang, word), not per occurrence.  A word's
suffixes meet the rules in one equality join on a hash of (lang, suffix), so
the cost does not grow with the number of rules, which may be a few or as many
as a morphological lexicon yields.

Defined results: a word without form or rule is its own lemma, and so is any
word of a language that neither names; a null lang is a language of its own
(``''``); null words are dropped.  A form listed twice takes the smallest
lemma, a suffix listed twice the smallest ending.  Rules leave at least
``stem`` letters of the word before the suffix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Irregular forms (lang, form, lemma).
FORMS = [("en", form, lemma) for lemma, forms in {
    "be": "am are been being is was were", "have": "had has having", "do": "did does doing done",
    "go": "goes going gone went", "say": "said says", "make": "made making", "take": "taken taking took",
    "come": "came coming", "see": "saw seen", "get": "getting got gotten", "give": "gave given giving",
    "find": "found", "know": "knew known", "think": "thought", "man": "men", "woman": "women",
    "child": "children", "foot": "feet", "mouse": "mice", "good": "best better", "bad": "worse worst",
}.items() for form in forms.split()]

# Endings (lang, suffix, what stands in its place).
ENDINGS = [
    ("en", "ches", "ch"), ("en", "ed", ""), ("en", "eed", "eed"), ("en", "ied", "y"), ("en", "ies", "y"),
    ("en", "ing", ""), ("en", "is", "is"), ("en", "s", ""), ("en", "shes", "sh"), ("en", "ss", "ss"),
    ("en", "sses", "ss"), ("en", "us", "us"), ("en", "xes", "x"), ("en", "ying", "y"),
    ("es", "ces", "z"), ("es", "iones", "ión"), ("es", "s", ""),
]

#: letters that a rule leaves before the suffix
STEM = 3


def form_table(spark: SparkSession, forms=FORMS) -> DataFrame:
    return spark.createDataFrame(list(forms), "lang string, form string, lemma string")


def ending_table(spark: SparkSession, endings=ENDINGS) -> DataFrame:
    return spark.createDataFrame(list(endings), "lang string, suffix string, ending string")


def lemma_map(words: DataFrame, forms: DataFrame, endings: DataFrame, stem: int = STEM) -> DataFrame:
    """(lang, word) rows, repeats allowed -> distinct (lang, word, lemma)."""
    lang = F.coalesce("lang", F.lit("")).alias("lang")
    w = words.where(F.col("word").isNotNull()).select(lang, "word").distinct()
    f = forms.groupBy(lang, F.col("form").alias("word")).agg(F.min("lemma").alias("_form"))
    r = endings.groupBy(lang, "suffix").agg(F.min("ending").alias("ending"))
    longest = endings.select(F.coalesce(F.max(F.length("suffix")), F.lit(0))).scalar()
    n = F.length("word")
    tails = (w.where(n > stem).withColumn("n", F.explode(F.when(
        F.least(longest, n - stem) >= 1, F.sequence(F.lit(1), F.least(longest, n - stem)))))
        .withColumn("suffix", F.substring("word", n - F.col("n") + 1, F.col("n")))
        .withColumn("_h", F.xxhash64("lang", "suffix")))
    rules = r.withColumn("_h", F.xxhash64("lang", "suffix"))
    # hashes find the rule, the strings confirm it
    best = (tails.join(rules, ["_h", "lang", "suffix"]).groupBy("lang", "word")
            .agg(F.max_by(F.struct("n", "ending"), "n").alias("_rule")))
    ruled = F.concat(F.substring("word", F.lit(1), n - F.col("_rule.n")), F.col("_rule.ending"))
    return (w.join(f, ["lang", "word"], "left").join(best, ["lang", "word"], "left")
            .select("lang", "word", F.coalesce("_form", ruled, "word").alias("lemma")))


#: words of a map that may be broadcast (about 100 bytes each)
BROADCAST_WORDS = 200_000


def lemma_counts(tf: DataFrame, forms: DataFrame, endings: DataFrame, stem: int = STEM) -> DataFrame:
    """(doc_id, lang, term, tf) -> (doc_id, lemma, tf): counts of words that
    share a lemma are added up.  The map has one row per word and is written;
    only words whose lemma is another travel to the counts, by broadcast while
    they are few (then nothing but the last sums is shuffled); a longer map is
    shuffled, and AQE splits a very common word's rows."""
    from quarry.session import shared_dir
    shared_dir(tf.sparkSession)
    t = tf.withColumn("lang", F.coalesce("lang", F.lit(""))).withColumnRenamed("term", "word")
    found = lemma_map(t.select("lang", "word"), forms, endings, stem).where("lemma <> word").checkpoint()
    if found.limit(BROADCAST_WORDS + 1).count() <= BROADCAST_WORDS:
        found = F.broadcast(found)
    return (t.where(F.col("word").isNotNull()).join(found, ["lang", "word"], "left")
            .groupBy("doc_id", F.coalesce("lemma", "word").alias("lemma")).agg(F.sum("tf").alias("tf")))
