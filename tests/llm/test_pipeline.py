"""The pipeline's stages against brute force, on tables of odd rows."""
import corpus_pipeline
from quarry.llm import toxicity

from tests.llm.conftest import rows_of
from tests.llm.test_sql import BENCH, WORDS, documents, phrase

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def near_groups(rows, k=5):
    """Rows that stay: texts whose words' shingle sets reach 0.8 are linked."""
    def grams(t):
        w = (t or "").lower().split()
        return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()
    sets = [(i, grams(t)) for i, t, *_ in rows]
    comp = {i: i for i, _ in sets}
    for _ in sets:
        for i, a in sets:
            for j, b in sets:
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    comp[i] = comp[j] = min(comp[i], comp[j])
    return {i for i in comp if comp[i] == i}


def odd():
    return documents() + [(40, "alpha you idiot moron alpha beta", "en", "s1", 1), (41, "write to me@here.org please", "en", "s2", 27)]


def test_stages(spark, tables):
    tables.put("documents", odd()).put("benchmark", BENCH).put("labels", [])
    docs = spark.read.parquet(f"{tables.dir}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)

    kept = stage["near_duplicates"](spark, docs, tables.dir)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == near_groups([r for r in odd()])

    clean = {r["doc_id"]: r["text"] for r in stage["decontaminate"](spark, docs, tables.dir).collect()}
    assert not {20, 21, 22, 23, 24, 33} & set(clean) and {25, 26, 27, 28, 32} <= set(clean)

    red = {r["doc_id"]: r for r in stage["pii"](spark, docs, tables.dir).collect()}
    assert red[41]["text"] == "write to <EMAIL> please" and red[41]["n_chars"] == 23
    assert red[25]["text"] is None and red[20]["text"] == documents()[20][1]

    mixed = stage["mix"](spark, docs, tables.dir).collect()
    sizes = {}
    for r in odd():
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").encode().split())
    got = {}
    for r in mixed:
        assert 0 < r["taken"] <= 2 * r["size"]
        assert r["taken"] >= r["size"] or len(r["text"].encode().split()) == r["taken"]
        got[r["source"]] = got.get(r["source"], 0) + r["taken"]
        assert r["source_size"] == sizes[r["source"]]
    for r in mixed:
        assert got[r["source"]] == int(r["target"])


def test_toxic_rows_go(spark, tables):
    insult = "idiot moron stupid worthless".split()
    rows = []
    for i in range(400):
        text = phrase(i, 25) + f" q{i}"
        rows.append((i, f"you {insult[i % 4]} {text} {insult[(i + 1) % 4]}" if i % 5 == 0 else text, "en", "s", 1))
    tables.put("documents", rows).put("labels", [(i, 1, int(i % 5 == 0)) for i in range(0, 400, 2)])
    docs = spark.read.parquet(f"{tables.dir}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs, tables.dir).collect()}
    assert kept == {i for i in range(400) if i % 5}


def test_repeated_ids_and_nulls(spark, tables):
    rows = [(1, phrase(1, 30), "en", "a", 1)] * 3 + [(None, phrase(1, 30), None, None, None), (None, None, None, None, None),
                                                    (2, phrase(1, 30), "en", "a", 1), (3, phrase(4, 30), "en", "b", 1)]
    tables.put("documents", rows).put("benchmark", [(None, None)]).put("labels", [(None, None, None)])
    out = rows_of(corpus_pipeline.run(spark, tables.dir), ["doc_id", "size"])
    assert sorted(str(r["doc_id"]) for r in out) == ["1", "3", "None"]


def test_ids_that_repeat_with_other_texts(spark, tables):
    """Texts under one id are not alike for that: of each text one copy stays."""
    a, b, c = phrase(1, 30), phrase(4, 30), phrase(7, 30)
    rows = [(5, a), (5, b), (3, a), (4, b), (6, c), (6, None), (6, c), (6, "")]
    tables.put("documents", [(i, t, "en", "s", 1) for i, t in rows])
    docs = spark.read.parquet(f"{tables.dir}/documents.parquet")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, tables.dir)
    assert kept.columns == docs.columns
    got = sorted((r["doc_id"], r["text"] or "") for r in kept.collect())
    assert got == sorted([(3, a), (4, b), (6, c), (6, ""), (6, "")])


def test_no_rows(spark, tables):
    for name in ("documents", "benchmark", "labels"):
        tables.put(name, [])
    assert corpus_pipeline.run(spark, tables.dir).count() == 0


def test_broadcasts_count_what_the_driver_holds(spark, monkeypatch):
    """A broadcast row takes its columns several times over on the driver:
    collected, hashed at up to twice the room and held in blocks."""
    from quarry.llm import overlap_join
    seen = []

    def bounded(df, width):
        seen.append((df.columns, width))
        return df
    monkeypatch.setattr(overlap_join, "bounded", bounded)
    words = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(words)), (2, " ".join(words + ["x"])), (3, "a b c d e f g h")]
    overlap_join.find(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80, 100)
    assert {"token"} in [set(c) for c, _ in seen]
    assert all(width >= 16 * len(c) + 64 for c, width in seen if "token" in c or "v" in c)
