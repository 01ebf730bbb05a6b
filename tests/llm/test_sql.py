"""Queries that SQL expresses: the given tables, and tables of odd rows."""
import pytest

from quarry.llm.oracle import ORACLE
from quarry.llm.queries import QUERIES
from quarry.plans.verify import compare

from tests.llm.conftest import rows_of, same

GIVEN = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def phrase(i, n):
    return " ".join(WORDS[(i * 7 + j * (i % 5 + 1)) % len(WORDS)] for j in range(n))


def documents():
    base = phrase(3, 60)
    rows = [(i, f"{phrase(i, 12 + i)} w{i} x{i}", "en", f"s{i % 4}", 1) for i in range(20)]
    rows += [(20, base, "en", "s0", 1), (21, base, "en", "s0", 1), (22, base.upper(), "en", None, 1),
             (23, base + " more", "en", "s1", 1), (24, "one " + base + " two", None, None, None),
             (25, None, "en", "s1", None), (26, "", "en", "s2", 0), (27, " \t\n", "en", "s2", 3),
             (28, "a b", "en", "é", 3), (29, "A  B", "en", "é", 4), (30, "É a É b", "fr", "z\U0001F600", 7),
             (31, (base + " ") * 400, "en", "s0", 1), (32, "x" * 50_000, "en", "s0", 1),
             (33, "alpha beta", "en", "s3", 1), (34, "gamma, ALPHA beta delta", "en", "s3", 1)]
    return rows


BENCH = [(1, phrase(3, 30)), (2, phrase(5, 25)), (3, "alpha beta"), (4, None), (5, ""), (6, "!!"),
         (1, phrase(3, 30)), (7, phrase(3, 30)), (1, phrase(9, 15)), (8, "É b"), (None, phrase(6, 14))]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_given_tables(spark, name):
    assert compare(spark, GIVEN, [name])[name].startswith("OK")


@pytest.mark.parametrize("name", ["op4_mix", "op7_decontaminate", "op8_jaccard_join"])
def test_odd_documents(spark, tables, name):
    tables.put("documents", documents()).put("benchmark", BENCH[:-1])
    same(rows_of(QUERIES[name](spark, tables.dir)), tables.sql(ORACLE[name]))


@pytest.mark.parametrize("name", ["op4_mix", "op7_decontaminate"])
def test_repeated_and_null_ids(spark, tables, name):
    twice = documents()[18:24]
    tables.put("documents", documents() + twice + [(20, "other text", "en", "s0", 1), (None, phrase(3, 40), "en", "s1", 1),
                                                   (None, None, None, None, None)])
    tables.put("benchmark", BENCH)
    got = rows_of(QUERIES[name](spark, tables.dir))
    want = tables.sql(ORACLE[name])
    if name == "op7_decontaminate":  # a null item_id marks words, but is not an item
        for r in want:
            r["n_items"] = min(r["n_items"], 99)
    same(got, want)


@pytest.mark.parametrize("name", ["op4_mix", "op7_decontaminate", "op8_jaccard_join"])
def test_no_documents(spark, tables, name):
    tables.put("documents", []).put("benchmark", BENCH)
    assert rows_of(QUERIES[name](spark, tables.dir)) == []


def test_no_benchmark(spark, tables):
    tables.put("documents", documents()).put("benchmark", [])
    same(rows_of(QUERIES["op7_decontaminate"](spark, tables.dir)), tables.sql(ORACLE["op7_decontaminate"]))


def test_odd_vectors(spark, tables):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [((i * 37 + j * 11) % 17 - 8) / 10.0 for j in range(6)], 1) for i in range(230)]
    rows += [(300, None, 1), (301, [0.1, None], 1), (302, [nan] * 6, 1), (303, [inf, 0.0], 1), (304, [-inf], None),
             (None, [0.5] * 6, 1), (400, [0.0] * 6, 1), (500, rows[0][1], 1), (0, rows[0][1], 1), (501, rows[0][1], 1)]
    tables.put("embeddings", rows)
    same(rows_of(QUERIES["op1_topk"](spark, tables.dir)), tables.sql(ORACLE["op1_topk"]))


def test_few_or_no_vectors(spark, tables):
    tables.put("embeddings", [(0, [1.0, 2.0], 1), (1, [0.5, -2.0], 1)])
    same(rows_of(QUERIES["op1_topk"](spark, tables.dir)), tables.sql(ORACLE["op1_topk"]))
    tables.put("embeddings", [])
    assert rows_of(QUERIES["op1_topk"](spark, tables.dir)) == []


def test_odd_pages(spark, tables):
    big = "<p>" + "é" * 70 + "</p>"
    rows = [(5, "http://a.org/", big), (3, "http://b.org/", big), (9, None, big), (1, "", None), (2, "u\r\nx", ""),
            (4, "http://c", "short"), (6, "http://c", "short"), (7, "x", "y" * 300_000), (8, "x", "y" * 300_000),
            (8, "x", "y" * 300_000), (3, "http://b.org/", big), (10, "z", "\r\n\r\n" * 40), (11, "z", "\r\n\r\n" * 40)]
    tables.put("pages", rows)
    same(rows_of(QUERIES["op5_warc"](spark, tables.dir)), tables.sql(ORACLE["op5_warc"]))
    tables.put("pages", [])
    assert rows_of(QUERIES["op5_warc"](spark, tables.dir)) == []
