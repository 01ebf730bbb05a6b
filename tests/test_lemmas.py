"""Lemmas against a plain version, and odd input."""

import random

from quarry.operators import lemmas


def plain(lang, word, forms, endings, stem):
    lang = lang or ""
    known = [m for g, f, m in forms if (g or "", f) == (lang, word)]
    if known:
        return min(known)
    fits = [(len(s), e) for g, s, e in endings if (g or "") == lang and word.endswith(s) and len(word) - len(s) >= stem]
    if not fits:
        return word
    n = max(k for k, _ in fits)
    return word[:len(word) - n] + min(e for k, e in fits if k == n)


def test_against_plain(spark):
    rng = random.Random(3)
    word = lambda least, most: "".join(rng.choice("abß") for _ in range(rng.randint(least, most)))
    langs = ["en", "de", None]
    forms = [(rng.choice(langs), word(1, 4), word(1, 3)) for _ in range(30)]
    endings = [(rng.choice(langs), word(1, 5), word(0, 2)) for _ in range(60)]
    words = [(rng.choice(langs + ["xx"]), word(1, 9)) for _ in range(600)]
    words += [(g, f) for g, f, _ in forms] + [("en", "a" * 5000)]
    for stem in (0, 2):
        got = lemmas.lemma_map(spark.createDataFrame(words + [("en", None)], "lang string, word string"),
                               lemmas.form_table(spark, forms), lemmas.ending_table(spark, endings), stem).collect()
        assert len(got) == len({(g or "", w) for g, w in words})
        assert [r for r in got if r["lemma"] != plain(r["lang"], r["word"], forms, endings, stem)] == []


def test_counts_and_empty_tables(spark):
    tf = spark.createDataFrame([(1, "en", "dogs", 2), (1, "en", "dog", 1), (1, "en", "went", 1), (2, "de", "dogs", 4),
                                (2, None, "x", 1)], "doc_id long, lang string, term string, tf long")
    f, e = lemmas.form_table(spark), lemmas.ending_table(spark)
    got = sorted(map(tuple, lemmas.lemma_counts(tf, f, e).collect()))
    assert got == [(1, "dog", 3), (1, "go", 1), (2, "dogs", 4), (2, "x", 1)]
    got = sorted(map(tuple, lemmas.lemma_counts(tf, f.limit(0), e.limit(0)).collect()))
    assert got == [(1, "dog", 1), (1, "dogs", 2), (1, "went", 1), (2, "dogs", 4), (2, "x", 1)]
    assert lemmas.lemma_counts(tf.limit(0), f, e).collect() == []


def test_terms_counted_inside_rows(spark):
    from quarry.operators import text
    rng = random.Random(5)
    rows = [(rng.choice([None, 1, 2, *range(10, 40)]), [rng.choice("abcdß") for _ in range(rng.randint(0, 9))]) for _ in range(60)]
    want = {}
    for d, words in rows:
        for w in words:
            want[d, w] = want.get((d, w), 0) + 1
    for some in (rows, []):
        got = text.term_counts(spark.createDataFrame(some, "doc_id long, words array<string>")).collect()
        assert len(got) == len({(r["doc_id"], r["term"]) for r in got})
        assert {(r["doc_id"], r["term"]): r["tf"] for r in got} == (want if some else {})
    once = spark.createDataFrame([(i, ["b", "a", "b"]) for i in range(50)], "doc_id long, words array<string>")
    counts = text.term_counts(once)
    assert sorted(map(tuple, counts.where("doc_id = 7").collect())) == [(7, "a", 1), (7, "b", 2)]
    # counts of unlike ids are not shuffled
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()


def test_only_changed_words_travel(spark, monkeypatch):
    rows = [(d, "en", w, 1 + d) for d in range(40) for w in ("dogs", "dog", "cat", "went", "es")] + [(1, "en", None, 3)]
    tf = spark.createDataFrame(rows, "doc_id long, lang string, term string, tf long")
    f, e = lemmas.form_table(spark), lemmas.ending_table(spark)
    want = {(d, m): n for d in range(40) for m, n in (("dog", 2 + 2 * d), ("cat", 1 + d), ("go", 1 + d), ("es", 1 + d))}
    for most in (10, 1):
        monkeypatch.setattr(lemmas, "BROADCAST_WORDS", most)
        got = lemmas.lemma_counts(tf, f, e)
        assert {(r["doc_id"], r["lemma"]): r["tf"] for r in got.collect()} == want
