"""Alignment against a plain two-pointer version, and the tokenizers' own files."""
import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import alignment
from quarry.llm.queries import QUERIES

from tests.llm.conftest import rows_of, same


@pytest.fixture(scope="module")
def sides():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(alignment.BYTE_BPE)
    t.encode_special_tokens = True
    return alignment.Aligner(alignment.BYTE_BPE, alignment.PIECES), t


def plain(texts, aligner, tokenizer):
    """The contract's rows, by sets of ends."""
    docs, pairs = [], Counter()
    for text in texts:
        raw = (" " + (text or "")).encode()
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        b = aligner.b.model.encode(text) if text else []
        if not text or b"".join(aligner.a.bytes[i] for i in a) != raw or b"".join(aligner.b.bytes[i] for i in b) != raw:
            a, b = [], []
        ea, eb = np.cumsum([len(aligner.a.bytes[i]) for i in a]).tolist(), np.cumsum([len(aligner.b.bytes[i]) for i in b]).tolist()
        ends = sorted(set(ea) & set(eb))
        links = [(a[ea.index(e)], b[eb.index(e)]) for e in ends]
        groups, i, j = [], 0, 0
        for e in ends:
            x, y = ea.index(e) + 1, eb.index(e) + 1
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            i, j = x, y
        pairs.update(links)
        docs.append((a, b, links, groups))
    top = {}
    for (_, y), n in pairs.items():
        top[y] = max(top.get(y, 0), n)
    return [{"n_a": len(a), "n_b": len(b), "n_groups": len(groups), "n_links": len(links),
             "n_best": sum(pairs[x] == top[x[1]] for x in links), "count_sum": sum(pairs[x] for x in links),
             "groups_sha256": hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""}
            for a, b, links, groups in docs]


def texts():
    rng = random.Random(5)
    words = "the Mädchen élève niño 12345 x = y; don't  naïve\t\n été über https://a.org/b?c=1 ﷽ 漢字 😀 ſ K".split(" ")
    out = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 90))) for _ in range(40)]
    return out + [None, "", " ", "\n", "  two", "<|endoftext|> <s></s> <unk>", "▁", "a▁b", "\x00", "é" * 3000, "ab " * 4000,
                  "same text", "same text", "‍", "x" * 20_000, "  " * 500, "１２", "á"]


def test_query_against_plain(spark, tables, sides):
    rows = [(i % 50, t, "en", "s", 1) for i, t in enumerate(texts())]
    tables.put("documents", rows)
    want = [{"doc_id": r[0], **w} for r, w in zip(rows, plain([r[1] for r in rows], *sides))]
    same(rows_of(QUERIES["op12_alignment"](spark, tables.dir)), want)


def test_given_documents(spark, sides):
    src = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{src}/documents.parquet").select("doc_id", "text").collect()
    want = [{"doc_id": r["doc_id"], **w} for r, w in zip(docs, plain([r["text"] for r in docs], *sides))]
    same(rows_of(QUERIES["op12_alignment"](spark, src)), want)


def test_no_documents(spark, tables):
    tables.put("documents", [])
    assert rows_of(QUERIES["op12_alignment"](spark, tables.dir)) == []


@settings(max_examples=80, deadline=None)
@given(st.sets(st.integers(1, 400)), st.sets(st.integers(1, 400)), st.integers(1, 50))
def test_common_ends(a, b, lane):
    ea, eb = (np.array(sorted({*x, 401}), np.int64) for x in (a, b))
    ia, ib = alignment.common_ends(ea, eb, lane)
    want = np.intersect1d(ea, eb)
    assert ea[ia].tolist() == want.tolist() == eb[ib].tolist()


def test_both_encoders_agree(sides):
    """Where the fast encoder is used it gives the tokenizer file's ids."""
    aligner, whole = sides
    rng = random.Random(2)
    plain_chars = [chr(c) for c in range(0x180)] + list("‘’“”…")
    assert all(alignment._PLAIN.fullmatch(c) for c in plain_chars)
    for _ in range(3000):
        s = "".join(rng.choice(plain_chars) for _ in range(rng.randrange(1, 30)))
        assert aligner.a.encode(s).tolist() == whole.encode(s, add_special_tokens=False).ids


def test_pairs_have_a_bound(spark, sides):
    aligner, _ = sides
    first = alignment.encode(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    pairs = alignment.pair_table(first, aligner.nb).collect()
    assert len(pairs) <= alignment.possible_pairs(aligner.a.bytes, aligner.b.bytes) < 1_000_000
    for r in pairs:
        x, y = aligner.a.bytes[r["a"]], aligner.b.bytes[r["b"]]
        assert x.endswith(y) or y.endswith(x)


def test_links_are_looked_up_in_bounded_slices(monkeypatch):
    """Rows of many links are not taken a whole batch at a time."""
    import numpy as np
    import pyarrow as pa
    monkeypatch.setattr(alignment, "LINKS", 10)
    rng = np.random.default_rng(4)
    rows = [rng.integers(0, 40, rng.integers(0, 25)).tolist() for _ in range(50)] + [[]]
    n = len(rows)
    keys = np.arange(40)
    counts, best = rng.integers(1, 1 << 40, 40), rng.integers(0, 2, 40).astype(bool)
    zero = pa.array([0] * n, pa.int64())
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), zero, zero, zero, pa.array([""] * n), pa.array(rows, pa.list_(pa.int64()))],
                                       names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links"])
    out = list(alignment._judge(keys, counts, best)([batch.slice(0, 20), batch.slice(20)]))
    assert max(sum(x.column("n_links").to_pylist()) for x in out if x.num_rows > 1) <= 10
    got = [r for x in out for r in x.to_pylist()]
    assert [r["doc_id"] for r in got] == list(range(n))
    assert [(r["n_links"], r["n_best"], r["count_sum"]) for r in got] == [
        (len(x), sum(bool(best[i]) for i in x), sum(int(counts[i]) for i in x)) for x in rows]
    seen = alignment.Counts()
    for x in rows:
        seen.add(np.array(x, np.int64))
    seen.settle()
    flat = [i for x in rows for i in x]
    assert dict(zip(seen.keys.tolist(), seen.counts.tolist())) == {i: flat.count(i) for i in flat}
    assert (np.diff(seen.keys) > 0).all()
