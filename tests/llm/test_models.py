"""Classifiers: held-out accuracy, odd rows, folds."""
import zlib

import pytest

from quarry.llm import quality, toxicity
from quarry.llm.queries import QUERIES

GIVEN = "/root/testdata/sf0.1"


@pytest.mark.parametrize("name,label,mod,held,least", [("op2_quality", "quality", 5, 0, 0.93),
                                                       ("op9_toxicity", "toxic", 4, 2, 0.96)])
def test_held_out_accuracy(spark, name, label, mod, held, least):
    got = {r["doc_id"]: r for r in QUERIES[name](spark, GIVEN).collect()}
    assert len(got) == spark.read.parquet(f"{GIVEN}/documents.parquet").count()
    for i, r in list(got.items())[:500]:
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % mod == held)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    truth = [(r["doc_id"], r[label]) for r in spark.read.parquet(f"{GIVEN}/labels.parquet").collect()]
    hits = [got[i]["predicted"] == y for i, y in truth if got[i]["held_out"]]
    assert sum(hits) / len(hits) >= least


ODD = [(1, None), (2, ""), (3, " "), (4, "word " * 100_000), (5, "\x00퟿ é"), (1, "again"), (None, "no id"), (7, "x" * 200_000)]


@pytest.mark.parametrize("labels", [[], [(2, 1, 0)], [(1, 1, 1), (2, 0, 0), (4, None, None), (None, 1, 1), (99, 1, 1)],
                                    [(i, i % 2, i % 2) for i in range(9)] * 2])
def test_odd_rows(spark, tables, labels):
    tables.put("documents", [(i, t, None, None, None) for i, t in ODD]).put("labels", labels)
    for name in ("op2_quality", "op9_toxicity"):
        rows = QUERIES[name](spark, tables.dir).collect()
        assert len(rows) == len(ODD)
        assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) and r["held_out"] is not None for r in rows)


def test_dictionaries_tell_texts_apart():
    good = [f"the quiet river runs past house {i} and the old mill by the wood".encode() for i in range(200)]
    bad = [f"BUY!! NOW!! CHEAP!! {i}!! DEAL!! DEAL!! CLICK!!".encode() for i in range(200)]
    s = quality.Sizer(quality.build_dictionary(good), quality.build_dictionary(bad))
    assert s.difference("the old house by the river and the quiet wood") > s.difference("CHEAP!! DEAL!! NOW!! CLICK!!")
    assert s.difference("") == s.difference(None) == 0.0


def test_lexicon_and_features():
    words, stems = toxicity.odds_lexicon([("idiot", 30, 0), ("the", 50, 500), ("^idio", 30, 1), ("rare", 2, 0)], 60, 600)
    assert set(words) == {"idiot"} and set(stems) == {"idio"}
    names = dict(zip(toxicity.NAMES, toxicity.features("You IDIOT! id1ot words", words, stems)))
    assert names["near_second"] > 0 and names["masked_hits"] > 0 and names["capitals"] > 0 and names["exclaims"] > 0
    assert toxicity.features(None, words, stems) == [0.0] * len(toxicity.NAMES)
