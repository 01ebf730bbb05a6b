"""Collocations against SQL and plain counts, and the sort by itself."""
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import collocations
from quarry.llm.oracle import ORACLE
from quarry.llm.queries import QUERIES

from tests.llm.conftest import rows_of, same


def documents():
    rng = random.Random(3)
    words = "the of Of THE quick brown fox é É jumps ünder a b 10 🙂".split(" ")
    rows = []
    for i in range(700):
        t = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", " ; "])
                    for _ in range(rng.randrange(0, 40)))
        rows.append((i % 300, t, rng.choice(["en", "fr", None, "und", ""]), "s", 1))
    rows += [(900 + i, "machine learning model is new york city hall", "en", "s", 1) for i in range(150)]
    rows += [(5, None, "en", "s", 1), (6, "", "xx", "s", 1), (7, " \t\n.,", None, "s", 1), (8, "word", "de", "s", 1)]
    rows += [(9, "New York city " * 5000, "en", "s", 1), (10, "q" * 30_000, "en", "s", 1), (None, "the of the of", None, None, 1)]
    return rows


@pytest.mark.parametrize("hot", [100_000, 3])
def test_odd_documents(spark, tables, monkeypatch, hot):
    monkeypatch.setattr(collocations, "HOT_ROWS", hot)
    monkeypatch.setattr(collocations, "SLICE", 1 << 12)
    tables.put("documents", documents())
    if hot > 3:
        same(rows_of(QUERIES["op11_collocations"](spark, tables.dir)), tables.sql(ORACLE["op11_collocations"]))
    docs = spark.read.parquet(f"{tables.dir}/documents.parquet")
    got = rows_of(collocations.collocations(docs, floor=6))
    assert len(got) > 200 and len({r["lang"] for r in got}) == 4
    same(got, tables.sql(ORACLE["op11_collocations"].replace("count(*) >= 100", "count(*) >= 6")))


def test_few_or_no_documents(spark, tables):
    tables.put("documents", [(1, "a b c", "en", "s", 1)])
    assert rows_of(QUERIES["op11_collocations"](spark, tables.dir)) == []
    tables.put("documents", [])
    assert rows_of(QUERIES["op11_collocations"](spark, tables.dir)) == []


def test_exact_beyond_64_bits(spark, monkeypatch):
    known = spark.createDataFrame([("en", "x", 3 * 10 ** 9), ("en", "y", 3 * 10 ** 9), ("en", "x y", 2 * 10 ** 9 + 7)],
                                  "lang string, phrase string, f long")
    total = spark.createDataFrame([("en", 10 ** 13 + 1)], "lang string, n long")
    monkeypatch.setattr(collocations, "frequent", lambda docs, floor: (known, total))
    row = collocations.collocations(known).first()
    assert row["score"] == 1000 * (2 * 10 ** 9 + 7) * (10 ** 13 + 1) // (9 * 10 ** 18)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=4), min_size=1, max_size=60), st.integers(1, 6))
def test_sort_counts_prefixes(rows, floor):
    keys = np.full((len(rows), 4), -1, np.int64)
    for i, r in enumerate(rows):
        keys[i, :len(r)] = r
    weight = np.arange(1, len(rows) + 1)
    got = {}
    for at, total, depth in collocations.multikey_sort(keys, weight, np.full(len(rows), floor)):
        for a, n in zip(at, total):
            assert tuple(keys[a, :depth]) not in got
            got[tuple(keys[a, :depth].tolist())] = int(n)
    want = Counter()
    for r, w in zip(rows, weight):
        for d in range(1, len(r) + 1):
            want[tuple(r[:d])] += int(w)
    assert got == {k: n for k, n in want.items() if n >= floor}
