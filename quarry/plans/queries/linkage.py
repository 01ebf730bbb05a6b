"""Record-linkage queries: header-in-data scan, pair statistics, match weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import linkage
from quarry.plans import roles
from quarry.plans.registry import query, r4
from quarry.session import shared_dir, stand_in_source
from quarry.sources import files, formats


def _link_counts(spark, d):
    return linkage.pair_field_counts(roles.linkage_records(spark, d), "block", "segment", roles.LINK_FIELDS)


@query("header_and_bad_rows")
def header_and_bad_rows(spark, d):
    """Text scan of a CSV whose header is a quoted line inside the data."""
    path = stand_in_source(spark, "linkage", d, lambda p: files.write_lines(roles.linkage_lines(spark, d), p))
    lines = files.drop_header_lines(files.read_lines(spark, path))
    a = F.split(F.col("value"), ",")
    return lines.select(a[0].try_cast("long").alias("id"), a[1].try_cast("int").alias("block"),
                        a[2].try_cast("double").alias("f_band"),
                        F.when(a[3] != "?", a[3]).alias("f_tail"),
                        a[4].try_cast("int").alias("f_cents"), a[5].alias("segment"))


@query("match_counts")
def match_counts(spark, d):
    return linkage.match_counts(_link_counts(spark, d))


@query("missing_stats")
def missing_stats(spark, d):
    s = linkage.missing_stats(_link_counts(spark, d))
    return s.select("matched", "field", "cnt", "missing", *[r4(c).alias(c) for c in ("mean", "stdev", "min", "max")])


@query("match_weights")
def match_weights(spark, d):
    """u comes from a frequencies CSV (header + one row) written and read back,
    its header linked to its values by unpivot."""
    fields = roles.LINK_FIELDS
    freq = linkage.value_frequencies(roles.linkage_records(spark, d), fields)
    path = files.write_csv(freq.coalesce(1), shared_dir(spark, "freq"))
    wide = files.read_csv(spark, path, files.double_schema(*fields), header=True)
    u_long = wide.unpivot([], fields, "field", "u")
    w = linkage.match_weights(_link_counts(spark, d), u_long)
    return w.select("field", *[r4(c).alias(c) for c in w.columns if c != "field"])


def _pairs(spark, d):
    path = stand_in_source(spark, "pairs", d, lambda p: files.write_lines(roles.pair_lines(spark, d), p))
    return formats.linkage_pairs(spark, path)


@query("pair_scores")
def pair_scores(spark, d):
    """Scored record pairs read from their CSV: statistics per score and flag."""
    s = linkage.score_stats(_pairs(spark, d))
    return s.select("matched", "pos", "cnt", "missing", *[r4(c).alias(c) for c in ("mean", "stdev", "min", "max")])


@query("pair_weights")
def pair_weights(spark, d):
    """Match weights from the scored pairs' own agreement: m among matched
    pairs, u among all."""
    pairs = _pairs(spark, d)
    u = (pairs.select(F.posexplode("scores").alias("pos", "s")).groupBy("pos")
         .agg((F.count_if(F.col("s") == 1.0).cast("double") / F.count(F.lit(1))).alias("u")))
    names = F.get(F.array(*[F.lit(x) for x in roles.PAIR_FIELDS]), F.col("pos"))
    w = linkage.weights_from_scores(pairs, u.select("pos", names.alias("field"), "u"))
    return w.select("field", *[r4(c).alias(c) for c in w.columns if c != "field"])
