"""Queries that SQL does not express, against plain Python on small tables."""
import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.llm import decontam, linkgraph, lpf, overlap_join, pii, topk
from quarry.llm.queries import QUERIES

from tests.llm.conftest import rows_of, same
from tests.llm.test_sql import documents, phrase


def repeats(docs, length):
    """Byte coverage by strings of ``length`` that start more than once."""
    seen = Counter(b[p:p + length] for b in docs for p in range(len(b) - length + 1))
    out = []
    for b in docs:
        cover = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                cover[p:p + length] = b"\x01" * length
        out.append(cover)
    return out


def texts():
    one = "".join(chr(97 + (i * i * 7 + i // 3) % 26) for i in range(900))
    two = "é" * 150 + one[100:700]
    return [(1, one), (2, "x" + one[:450] + "y"), (3, two), (4, two), (5, None), (6, ""), (7, "ab" * 700),
            (8, one[200:599]), (9, one[200:600]), (10, "short"), (11, one[300:] + one[:820]), (3, two), (12, "q" * 399),
            (13, "q" * 400), (14, "r" * 400), (15, one[450:] + "tail" + one[:450]), (None, one[:420])]


@pytest.mark.parametrize("wide", [1000, 1])
def test_repeats(spark, tables, monkeypatch, wide):
    rows = texts()
    tables.put("documents", [(i, t, "en", "s", 1) for i, t in rows])
    whole = lpf.remove_repeats
    monkeypatch.setattr(lpf, "remove_repeats", lambda *a, **k: whole(*a, **k, wide=wide))
    monkeypatch.setattr(lpf, "PIECE", 1 << 8)
    raw = [(t or "").encode() for _, t in rows]
    want = []
    for (i, _), b, c in zip(rows, raw, repeats(raw, 400)):
        kept = bytes(x for x, y in zip(b, c) if not y)
        runs = sum(1 for p in range(len(b)) if c[p] and (p == 0 or not c[p - 1]))
        want.append({"doc_id": i, "n_bytes": len(b), "n_removed": sum(c), "n_spans": runs,
                     "kept_sha256": hashlib.sha256(kept).hexdigest()})
    same(rows_of(QUERIES["op3_repeats"](spark, tables.dir)), want)


def test_first_copy_stays(spark):
    a = "".join(chr(97 + (i * i * 3 + i // 7) % 26) for i in range(120))
    docs = spark.createDataFrame([(2, a), (1, "zz" + a + a[:50]), (3, a[10:80] + "!")], "doc_id long, text string")
    got = {r["doc_id"]: bytes(r["kept"]).decode() for r in lpf.remove_repeats(docs, 30, keep="first").collect()}
    assert got == {1: "zz" + a, 2: "", 3: "!"}


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=200).map(lambda b: bytes(x % 3 for x in b)), st.integers(1, 40))
def test_truncated_order(data, length):
    buf = np.frombuffer(data, np.uint8)
    starts = np.arange(max(0, len(buf) - length + 1))
    if not len(starts):
        return
    rank, _ = lpf.suffix_order(buf, starts, length)
    cut = [data[p:p + length] for p in starts]
    assert list(rank) == [sorted(set(cut)).index(c) for c in cut]


@settings(max_examples=80, deadline=None)
@given(st.binary(min_size=1, max_size=160).map(lambda b: bytes(x % 3 for x in b)), st.integers(1, 40))
def test_longest_previous_factors(data, length):
    buf = np.frombuffer(data, np.uint8)
    starts = np.arange(max(0, len(buf) - length + 1))
    if not len(starts):
        return

    def common(a, b):
        n = 0
        while n < length and data[a + n] == data[b + n]:
            n += 1
        return n
    rank, steps = lpf.suffix_order(buf, starts, length)
    order = np.argsort(rank, kind="stable")
    lcp = lpf.neighbour_lcp(buf, starts[order], rank[order[1:]] == rank[order[:-1]], steps, length)
    assert list(lcp) == [common(a, b) for a, b in zip(order, order[1:])]
    assert list(lpf.previous_factors(order, lcp, length)) == [
        max([common(p, q) for q in range(p)], default=0) for p in starts]
    assert list(lpf.previous_factors(order, lcp, length, later=True)) == [
        max([common(p, q) for q in range(p + 1, len(starts))], default=0) for p in starts]


def test_buffers_end_where_a_key_ends(monkeypatch):
    import pyarrow as pa
    rng = np.random.default_rng(0)
    rows = []
    for key in range(40):
        text = bytes(rng.integers(97, 100, 60).astype(np.uint8))
        rows += [{"doc_id": key * 10 + i, "h": 0, "key": key, "first": 5, "bytes": text[:50 - i]} for i in range(key % 4 + 1)]
    schema = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("key", pa.int64()), ("first", pa.int32()), ("bytes", pa.binary())])

    def flagged(size, batch):
        monkeypatch.setattr(lpf, "BUFFER", size)
        batches = [pa.RecordBatch.from_pylist(rows[i:i + batch], schema=schema) for i in range(0, len(rows), batch)]
        out = list(lpf._sort_buffers(20, "none")(iter(batches)))
        return len(out), {(r["doc_id"], p) for b in out for r in b.to_pylist() for p in range(r["first"], r["last"] + 1)}
    want = set()
    for r in rows:
        mates = [o for o in rows if o["key"] == r["key"]]
        for p in range(len(r["bytes"]) - 19):
            cut = r["bytes"][p:p + 20]
            if sum(o["bytes"][q:q + 20] == cut for o in mates for q in range(len(o["bytes"]) - 19)) > 1:
                want.add((r["doc_id"], p + 5))
    for size, batch in ((1, 7), (1, 1000), (300, 3), (1 << 20, 9)):
        n, got = flagged(size, batch)
        assert want <= got
        if size == 1:
            assert n == 40 and got == want


def test_no_texts(spark, tables):
    tables.put("documents", []).put("labels", [])
    for name in ("op2_quality", "op3_repeats", "op9_toxicity", "op10_pii"):
        assert rows_of(QUERIES[name](spark, tables.dir)) == []


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    twice = [int(c) * 2 if i % 2 else int(c) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in twice) % 10 == 0


def base_spans(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m.group(0))
            if kind == "ip" and any(int(x) > 255 for x in m.group(0).split(".")):
                continue
            if kind == "card" and not (16 <= len(d) <= 19 and luhn(d)):
                continue
            if kind == "phone" and not 8 <= len(d) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


PERSONAL = ["mail a.b+c@x-y.example.com, or é@b.c é é q@r.s.t.", "a@b.c_x@d.e a@b@c.d .@d.e %@-.-", "10.0.0.255 256.1.1.1 1.2.3.4.5.6.7",
            "0000255.01.1.1 and 999999999999999999999.1.1.1", "4111 1111 1111 1111 / 4111-1111-1111-1112 / 4111111111111111",
            "+1 (017) 555-7713; +12; +1234567 8; +123456789012345678", "\U0001F600 +49 30 1234567 \U0001F600 x@y.zz",
            'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" and password=18a0165473c0330cab', "version 1.2.3", "", None,
            "1" * 20_000, "a" * 30_000, "a@" * 2_000, "1 " * 3_000, "+1(" * 500, "call 030 1234 5678 now",
            "a@b" + ".c" * 4_000, "call 030 1234 5678 now"]


def test_base_spans(spark, tables):
    rows = [(i, t) for i, t in enumerate(PERSONAL)] + [(0, PERSONAL[0]), (0, PERSONAL[2]), (None, PERSONAL[4])]
    tables.put("documents", [(i, t, "en", "s", 1) for i, t in rows])
    got = sorted(((r["doc_id"] is None, r["doc_id"]), r["base_sha256"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"])
                 for r in QUERIES["op10_pii"](spark, tables.dir).collect())
    want = []
    for i, t in rows:
        s = base_spans(t or "")
        c = Counter(x.split(":")[0] for x in s)
        want.append(((i is None, i), hashlib.sha256(",".join(s).encode()).hexdigest(), *(c[k] for k in PATTERNS)))
    assert got == sorted(want)


def test_method_adds_spans_and_redacts(spark):
    key = [f'x{i} token = "{hashlib.sha1(str(i).encode()).hexdigest()}" y' for i in range(30)]
    plain = [f"order {i} has internationalisation-{i} and 20{i % 10}0 parts" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(key + plain + ["mail me@here.org now"])), "doc_id long, text string")
    spans = {r["doc_id"]: [(x["kind"], x["start"], x["end"]) for x in r["spans"]] for r in pii.report(docs).collect()}
    for i, t in enumerate(key):
        at = t.index('"') + 1
        assert spans[i] == [("secret", at, at + 40)]
    assert all(spans[i] == [] for i in range(30, 90))
    text = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert text[0] == 'x0 token = "<SECRET>" y' and text[90] == "mail <EMAIL> now" and text[30] == plain[0]


def test_em_finds_the_reliable_labelers():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.3
    votes = np.zeros((4000, 4), int)
    for j, right in enumerate((0.95, 0.9, 0.85, 0.5)):
        votes[:, j] = np.where(rng.random(4000) < right, truth, ~truth) * 2 - 1
    counts = sorted(Counter(map(tuple, votes.tolist())).items())
    p, table = pii.em(counts)
    by = dict(zip([c[0] for c in counts], p))
    assert np.mean([(by[tuple(v)] >= 0.5) == t for v, t in zip(votes.tolist(), truth)]) > 0.93
    assert table[0][1][0] > table[2][1][0] > table[3][1][0]


@pytest.mark.parametrize("short", [0, 1, 2, 7])
def test_divide_skip(short):
    rng = np.random.default_rng(short)
    sets = [np.unique(rng.integers(0, 60, 25 + i % 9).astype(np.uint64)) for i in range(120)]
    index = overlap_join.Lists(sets)
    for q in sets[:40]:
        want = [i for i, s in enumerate(sets)
                if 100 * len(np.intersect1d(q, s)) >= 60 * len(np.union1d(q, s))]
        assert sorted(index.search(q, 60, 100)) == want
    assert overlap_join.Lists([]).search(sets[0], 60, 100) == []


def test_chunks_meet(spark, monkeypatch):
    """Small chunks: families, chains and hot passages give the components of
    all pairs."""
    monkeypatch.setattr(overlap_join, "CHUNK", 300)
    rng = np.random.default_rng(5)
    vocab = [f"w{i}" for i in range(400)]
    shared = list(rng.choice(vocab, 40))
    rows, k = [], 0
    for f in range(8):
        doc = list(rng.choice(vocab, 60)) if f < 6 else shared + list(rng.choice(vocab, 6))
        for _ in range(14):
            rows.append((k, " ".join(doc)))
            k += 1
            doc = list(doc)
            doc[int(rng.integers(len(doc)))] = f"e{k}"
    sets = {i: {tuple(t.split()[j:j + 4]) for j in range(len(t.split()) - 3)} for i, t in rows}
    comp = {i: i for i in sets}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                comp[max(x, y)] = min(x, y)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in overlap_join.near_duplicates(docs, 4, 85, 100).collect()}
    assert got == {i: root(i) for i in sets}
    assert len(set(got.values())) < len(got)


@pytest.mark.parametrize("chunk", [300, 100_000])
def test_no_link_is_lost(spark, monkeypatch, chunk):
    """Every pair that reaches the threshold is a link, not only a spanning
    set of them; copies and rows that share an id add none."""
    monkeypatch.setattr(overlap_join, "CHUNK", chunk)
    rng = np.random.default_rng(3)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for f in range(3):
        doc = list(rng.choice(vocab, 250))
        for _ in range(14):
            rows.append((len(rows), " ".join(doc)))
            doc = list(doc)
            doc[int(rng.integers(len(doc)))] = f"e{len(rows)}"
    rows += [(100, rows[0][1]), (3, rows[3][1]), (None, rows[1][1]), (101, None)]
    sets = {i: {tuple(t.split()[j:j + 4]) for j in range(len(t.split()) - 3)} for i, t in rows[:42]}
    want = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(min(r["a_id"], r["b_id"]), max(r["a_id"], r["b_id"])) for r in overlap_join.links(docs, 4, 85, 100).collect()]
    assert len(want) > 100 and sorted(got) == sorted(want)
    n = {i: sum(i in p for p in want) for i in sets}
    found = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["class_id"], r["n_links"])
                   for r in overlap_join.link_counts(docs, 4, 85, 100).collect())
    assert found == sorted([(i, i, n[i]) for i in sets] + [(3, 3, n[3]), (100, 0, n[0]), (101, None, 0), (-1, None, 0)])


def test_repeated_and_null_ids_in_the_join(spark):
    t = phrase(2, 40)
    docs = spark.createDataFrame([(5, t), (3, t + " x"), (5, "other words here now then"), (None, t), (9, None), (9, ""),
                                  (4, "other words here now then"), (4, "other words here now then")],
                                 "doc_id long, text string")
    got = sorted(((r["doc_id"] or -1), r["n_shingles"], r["component_id"])
                 for r in overlap_join.near_duplicates(docs, 4, 85, 100).collect())
    n = len({tuple(t.split()[i:i + 4]) for i in range(37)})
    assert [(a, c) for a, _, c in got] == [(-1, None), (3, 3), (4, 3), (4, 3), (5, 3), (5, 3), (9, 9), (9, 9)]
    assert got[0][1] == n


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a b c x d e"), (2, "e d c b a"), (3, "a b c z z z z z z d e"), (4, "a b d e")],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(7, "a b c d e")], "item_id long, text string")
    post, iw = decontam.index_of(docs, items)
    for slack, want in ((0, [2]), (1, [1, 2]), (6, [1, 2, 3])):  # the window is the item's five words
        near = decontam.near_matches(post, iw, n=10, slack=slack)
        assert sorted({r["doc_id"] for r in near.collect()}) == want


def test_search_reads_only_what_it_must():
    rng = np.random.default_rng(3)
    mat = rng.integers(-300, 300, (2000, 24))
    index = topk.SegmentIndex(mat)
    for q in mat[:20]:
        may, score, used = index.search(q, 10)
        full = mat @ q
        assert set(np.argsort(-full)[:10]) <= set(may) and (full[may] == score).all() and used <= mat.size


PAGES = [(1, "http://A.example.org/es/x", None), (2, "https://b.org/p?q", None), (3, "https://w.bad.com/de/1#z", None),
         (4, "https://w.bad.com/xx", '<a href="//c.net/a">'), (5, "http://c.net/i", '<a href="http://w.bad.com/de/">'),
         (6, None, None), (7, "nothing", "x"), (8, "http://example.org/en/12", ""), (9, "http://org", None),
         (10, "http://xorg/", None), (11, "ftp://d.fr.com?x/fr/", None), (12, "http://fr.com/fr/a", None),
         (12, "http://fr.com/fr/a", None), (None, "http://q.org//", None)]


def test_rules(spark, tables):
    tables.put("pages", PAGES)
    got = {r["page_id"]: r for r in QUERIES["op6_url_filter"](spark, tables.dir).collect()}
    pick = lambda i: (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"])
    assert pick(1) == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert pick(2) == ("b.org", "/p", "org/", "allow")
    assert pick(3) == ("w.bad.com", "/de/1", "com/de/", "block")
    assert pick(4)[2:] == (None, "block")       # the host's other page is blocked
    assert pick(5)[2:] == (None, "block")       # it links to the blocked host
    assert pick(6) == ("", "", None, "allow") and pick(7) == ("", "", None, "allow")
    assert pick(8) == ("example.org", "/en/12", "example.org/en/1", "block")
    assert pick(9) == ("org", "", None, "allow") and pick(10) == ("xorg", "/", None, "allow")
    assert pick(11)[:3] == ("d.fr.com", "", None) and pick(12)[2:] == ("com/fr/", "allow")
    assert got[None]["rule"] == "org/" and QUERIES["op6_url_filter"](spark, tables.dir).count() == len(PAGES)
    tables.put("pages", [])
    assert rows_of(QUERIES["op6_url_filter"](spark, tables.dir)) == []


def test_rank_is_the_walk(spark):
    e = [("a", "b", 1.0), ("a", "c", 3.0), ("b", "c", 1.0), ("c", "a", 2.0), ("d", "a", 1.0)]
    names = sorted({x for s, d, _ in e for x in (s, d)})
    m = np.zeros((4, 4))
    for s, d, w in e:
        m[names.index(d), names.index(s)] = w
    m = m / m.sum(axis=0)
    seed = np.array([0.0, 0.0, 0.0, 1.0])
    x = np.linalg.solve(np.eye(4) - 0.85 * m, 0.15 * seed)
    got = linkgraph.personalised_rank(spark.createDataFrame(e, "src string, dst string, weight double"),
                                      spark.createDataFrame([("d", 1.0)], "host string, mass double"), 0.85, 1e-12)
    got = {r["host"]: r["score"] for r in got.collect()}
    assert np.allclose([got.get(n, 0.0) for n in names], x)


def test_queries_meet_blocks_without_a_broadcast(spark):
    """The queries are repeated for every block of vectors, which a size from
    before the repeat hides: such a side must never be sent to the driver."""
    v = spark.range(300).select("id", F.array(F.col("id") % 7, F.col("id") % 5).alias("vec"))
    found = topk.top_k(v, v.where("id % 10 = 0"), k=3, base_rows=20, query_rows=8)
    got = found.select("query_id", "vec_id", "rank").collect()
    vec = {i: (i % 7, i % 5) for i in range(300)}
    for q in range(0, 300, 10):
        best = sorted((i for i in vec if i != q), key=lambda i: (-vec[i][0] * vec[q][0] - vec[i][1] * vec[q][1], i))[:3]
        assert [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] == best
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
