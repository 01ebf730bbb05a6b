"""Co-occurrence, chi-square edges and citation XML queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import cooccur
from quarry.plans import roles
from quarry.plans.registry import query, r4
from quarry.sources import files

CHI_THRESHOLD = 3.84  # 5 % level, 1 dof; the fixtures have no pair above 19.5


@query("topic_freq")
def topic_freq(spark, d):
    return cooccur.item_frequency(roles.basket_items(spark, d), "topic")


@query("freq_of_freq")
def freq_of_freq(spark, d):
    return cooccur.frequency_of_frequency(topic_freq(spark, d))


@query("pair_counts")
def pair_counts(spark, d):
    dist = cooccur.distinct_baskets(roles.basket_items(spark, d), "basket", "topic")
    return cooccur.pair_counts(dist)


@query("hash_collisions")
def hash_collisions(spark, d):
    return cooccur.hash_collision_check(roles.basket_items(spark, d), "topic")


@query("cooccurrence_chisq")
def cooccurrence_chisq(spark, d, threshold: float = CHI_THRESHOLD):
    dist = cooccur.distinct_baskets(roles.basket_items(spark, d), "basket", "topic")
    e = cooccur.chi_square_edges(dist, roles.basket_total(spark, d), threshold)
    return e.withColumn("chisquare", r4("chisquare"))


@query("xml_wholetext_topics")
def xml_wholetext_topics(spark, d):
    """Whole-file scan (gzip) of the citation XML, major topics by XPath with an
    attribute predicate, then the topic frequency table.  Each row is one
    written part file (bounded by its number of citations), cut into its
    citations before the XPath, so no tree of a whole file is built; the
    rowTag reader in ``xml_topics`` is the record-at-a-time path."""
    path = roles.citation_xml(spark, d)
    # part files of empty partitions hold no root element: skip them
    docs = files.read_lines(spark, path, whole_text=True).where(F.col("value").contains("<MedlineCitation"))
    found = docs.select(files.elements("value", "MedlineCitation").alias("found"))
    cits = found.select(F.explode(files.element_groups(F.col("found"))).alias("value"))
    xp = '//MedlineCitation/MeshHeadingList/MeshHeading/DescriptorName[@MajorTopicYN="Y"]/text()'
    topics = cits.select(F.explode(F.xpath(F.col("value"), F.lit(xp))).alias("topic"))
    return cooccur.item_frequency(topics, "topic")


@query("xml_topics")
def xml_topics(spark, d):
    """Citations written as gzip XML, read back one row per child of the root,
    major topics picked by attribute."""
    path = roles.citation_xml(spark, d)
    cit = files.read_xml(spark, path, "MedlineCitation", roles.citation_schema())
    return cooccur.major_topics(cit)


def _pruned_graph(spark, d, threshold: float = CHI_THRESHOLD):
    """Topic graph keeping only edges with chi-square above the threshold;
    vertices are all topics (8-hex md5 ids)."""
    items = roles.basket_items(spark, d)
    dist = cooccur.distinct_baskets(items, "basket", "topic")
    e = cooccur.chi_square_edges(dist, roles.basket_total(spark, d), threshold).select("src", "dst").checkpoint()
    v = cooccur.vertex_ids(items, "topic")
    return v, e


@query("interesting_components")
def interesting_components(spark, d):
    """Connected components of the chi-square-pruned co-occurrence graph."""
    from quarry.operators import graph
    v, e = _pruned_graph(spark, d)
    return graph.connected_components(v.select("id"), e).join(v, "id").select("id", "topic", "component")


@query("interesting_degrees")
def interesting_degrees(spark, d):
    """Degree of each topic in the pruned graph (topics without edges absent)."""
    from quarry.operators import graph
    v, e = _pruned_graph(spark, d)
    return v.join(graph.degrees(e), "id").select("id", "topic", "degree")


@query("interesting_triangles")
def interesting_triangles(spark, d):
    """Triangles per topic of the pruned graph."""
    from quarry.operators import graph
    v, e = _pruned_graph(spark, d)
    return graph.triangle_count(v.select("id"), e)


@query("interesting_clustering")
def interesting_clustering(spark, d):
    """Local clustering coefficient per topic of the pruned graph."""
    from quarry.operators import graph
    v, e = _pruned_graph(spark, d)
    c = graph.clustering_coefficient(v.select("id"), e)
    return c.select("id", "triangles", "degree", r4("coef").alias("coef"))


@query("interesting_landmarks")
def interesting_landmarks(spark, d):
    """Hops from 5 % of the topics along the pruned graph's edges, either way."""
    from quarry.operators import graph
    v, e = _pruned_graph(spark, d)
    lm = graph.sample_vertices(v.select("id"), 0.05, seed=1)
    return graph.landmark_distances(lm, graph.undirected(e))
