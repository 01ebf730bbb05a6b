"""Toxicity score: gradient-boosted trees over dense text features, with
isotonic calibration.

Features of a whole text: densities of learned lexicons (whole words, word
beginnings, words read through their obfuscation), lexicon words near a word
of the second person, second-person words, capitals, exclamation marks and
other punctuation, words with digits or signs between letters, and length.

The lexicons hold the words, and the beginnings of 4 to 6 letters, whose
document odds in toxic over other labelled texts are significantly high.  The
trees are trained on features from lexicons that did not see the text (one of
``FOLDS`` folds left out), the calibration on texts that the trees did not see.

Bounds (documented parameters): at most ``most`` labelled documents outside
the held-out fold, at most ``LEXICON`` candidates of lexicon entries.

Defined results: null and empty texts have zero features and their score;
without labels of both kinds every text scores the common label (0 without
any); rows sharing an id are scored each by its own text; an empty table gives
no rows.  Only doc_id and text are read of the documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import crc_fold, labelled, written

FOLDS = 4
LEXICON = 50_000
STEMS = (4, 5, 6)
#: fixed values: second-person words of the corpus' languages
SECOND = frozenset("you your yours yourself thou tu te toi vous votre vos ton tes usted ustedes vosotros tus "
                   "du dich dir dein deine ihr euch".split())
#: fixed values: signs that stand for letters
UNMASK = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i",
                        "*": None, ".": None, "-": None, "_": None})
MASKED = re.compile(r"[^\W\d_][0-9@$!*._-]+[^\W\d_]")
EDGES = ".,;:!?\"'()[]{}<>|*&%$#/\\-_=+~`"
NOT_UPPER = bytes(c for c in range(256) if not 65 <= c <= 90)
NOT_PUNCT = bytes(c for c in range(256) if not (33 <= c <= 47 or 58 <= c <= 64 or 91 <= c <= 96 or 123 <= c <= 126))
NAMES = ("word_density", "stem_density", "word_hits", "stem_hits", "top_odds", "near_second", "second_density",
         "capitals", "exclaims", "punctuation", "masked", "masked_hits", "log_words")


def entries(word: str) -> set[str]:
    """Lexicon keys of a word: itself and its beginnings (marked with ^)."""
    return {word} | {f"^{word[:k]}" for k in STEMS if len(word) >= k}


def bare(word: str) -> str:
    return word.strip(EDGES)


def features(text: str | None, words: dict[str, float], stems: dict[str, float]) -> list[float]:
    text = text or ""
    seq = text.lower().split()
    n = len(seq)
    if n == 0:
        return [0.0] * len(NAMES)
    raw = text.encode("utf-8", "surrogatepass")
    count = Counter(seq)
    hits: dict[str, float] = {}
    w_sum = s_sum = top = 0.0
    w_n = s_n = m_n = masked = second = 0
    for token, c in count.items():
        w = bare(token)
        odds = words.get(w)
        if odds is not None:
            w_sum, w_n = w_sum + odds * c, w_n + c
            hits[token] = odds
        stem = 0.0
        for k in STEMS:
            if len(w) >= k:
                stem = max(stem, stems.get(w[:k], 0.0))
        if stem:
            s_sum, s_n = s_sum + stem * c, s_n + c
            hits[token] = max(stem, hits.get(token, 0.0))
        if w in SECOND:
            second += c
        if not w.isalpha() and MASKED.search(w):
            masked += c
            plain = w.translate(UNMASK)
            if plain in words:
                m_n += c
                hits[token] = words[plain]
    near = 0
    if hits:
        top = max(hits.values())
        last_second = last_hit = -99
        for i, token in enumerate(seq):
            if bare(token) in SECOND:
                last_second = i
                near += int(i - last_hit <= 6)
            if token in hits:
                last_hit = i
                near += int(i - last_second <= 6)
    size = len(raw)
    return [w_sum / n, s_sum / n, math.log1p(w_n), math.log1p(s_n), top, near / n, second / n,
            len(raw.translate(None, NOT_UPPER)) / size, text.count("!") / size,
            len(raw.translate(None, NOT_PUNCT)) / size, masked / n, math.log1p(m_n), math.log1p(n)]


def odds_lexicon(seen: list[tuple[str, int, int]], toxic: int, other: int, z: float = 3.0) -> tuple[dict, dict]:
    """(entry, toxic documents, other documents) -> words and stems whose
    smoothed log odds exceed 0 by ``z`` standard errors and are at least 2."""
    words, stems = {}, {}
    for key, a, b in seen:
        odds = math.log((a + 0.5) / (toxic - a + 0.5)) - math.log((b + 0.5) / (other - b + 0.5))
        if odds >= 2 and odds / math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5)) >= z:
            if key.startswith("^"):
                stems[key[1:]] = odds
            else:
                words[key] = odds
    return words, stems


def _entries_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(fold, label, text) -> (fold, label, entry): each text's distinct entries."""
    for batch in batches:
        for fold, label, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            keys = set()
            for token in set((text or "").lower().split()):
                w = bare(token)
                if w:
                    keys |= entries(w)
            yield pa.RecordBatch.from_arrays(
                [pa.array([fold] * len(keys), pa.int32()), pa.array([label] * len(keys), pa.int32()),
                 pa.array(sorted(keys), pa.string())], names=["fold", "label", "entry"])


def learn_lexicons(rows: DataFrame) -> list[tuple[dict, dict]]:
    """Labelled (fold, label, text) -> FOLDS lexicons, each without its fold,
    and last one of all folds."""
    size = {(r["fold"], r["label"]): r["n"] for r in rows.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    keys = rows.select("fold", "label", "text").mapInArrow(_entries_of, "fold int, label int, entry string")
    per = [F.sum(((F.col("fold") == f) & (F.col("label") == v)).cast("int")).alias(f"c{f}_{v}")
           for f in range(FOLDS) for v in (0, 1)]
    found = (keys.groupBy("entry").agg(*per, F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
             .where("a >= 3 and a > b * 0.5").orderBy(F.desc(F.col("a") / (F.col("b") + 1)), "entry").limit(LEXICON).collect())
    out = []
    for left in [*range(FOLDS), None]:
        use = [f for f in range(FOLDS) if f != left]
        seen = [(r["entry"], sum(r[f"c{f}_1"] for f in use), sum(r[f"c{f}_0"] for f in use)) for r in found]
        out.append(odds_lexicon(seen, sum(size.get((f, 1), 0) for f in use), sum(size.get((f, 0), 0) for f in use)))
    return out


def _training_features(lexicons: list[tuple[dict, dict]]):
    """(doc_id, text, fold, label) -> doc_id, label, features; each text takes
    the lexicon that left its fold out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t.as_py(), *lexicons[f]) for t, f in zip(batch.column(1), batch.column(2).to_pylist())]
            cols = [pa.array([r[i] for r in rows], pa.float64()) for i in range(len(NAMES))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), *cols],
                                             names=["doc_id", "label", *NAMES])
    return run


FEATURES = ", ".join(f"{c} double" for c in NAMES)
#: columns that the model adds on its way; a caller's columns keep their names
VEC, CLASS, PROB, RAW = "_tox_vec", "_tox_class", "_tox_prob", "_tox_raw"


def _vectors(feats: DataFrame, names: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=names, outputCol=VEC).transform(feats)


class Model:
    """Lexicons, trees and calibration; ``flat`` is the score where nothing
    could be learned."""

    def __init__(self, lexicons=None, trees=None, rise=None, flat: float = 0.0):
        self.lexicons, self.trees, self.rise, self.flat = lexicons, trees, rise, flat

    def margin(self, vectors: DataFrame) -> DataFrame:
        """Adds the trees' probability as ``_tox_x``."""
        return self.trees.transform(vectors).withColumn("_tox_x", vector_to_array(PROB)[1])

    def attach(self, docs: DataFrame) -> DataFrame:
        """``docs`` (with a column text, any others) plus ``_tox_score``."""
        if self.trees is None:
            return docs.withColumn("_tox_score", F.lit(self.flat))
        lexicon = self.lexicons[-1]

        @F.pandas_udf(FEATURES)
        def feats(texts: pd.Series) -> pd.DataFrame:
            return pd.DataFrame([features(t, *lexicon) for t in texts], columns=list(NAMES))
        kept = docs.columns
        names = [f"_tox_{c}" for c in NAMES]
        f = docs.withColumn("_tox_f", feats("text")).select(*kept, *[F.col(f"_tox_f.{c}").alias(n)
                                                                    for c, n in zip(NAMES, names)])
        out = self.rise.transform(self.margin(_vectors(f, names)))
        return out.select(*kept, F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("_tox_rise"))).alias("_tox_score"))


#: parts of the labelled rows for the calibration
PARTS = 3


def fit(docs: DataFrame, labels: DataFrame, what: str = "toxic", mod: int = 4, held: int = 2, most: int = 20_000,
        trees: int = 20, depth: int = 4) -> Model:
    rows = labelled(docs, labels, what, mod, held, most)
    rows = written(rows.select("doc_id", "text", (F.col("pick") % FOLDS).cast("int").alias("fold"), "label", "pick"),
                   "toxic-sample")
    kinds = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(kinds) < 2:
        return Model(flat=float(next(iter(kinds), 0)))
    lexicons = learn_lexicons(rows)
    feats = written(rows.select("doc_id", "text", "fold", "label")
                    .mapInArrow(_training_features(lexicons), "doc_id long, label int, " + FEATURES), "toxic-features")
    # each label's rows are dealt to PARTS parts: a part is scored by trees that have not seen it
    deal = Window.partitionBy("label").orderBy(F.xxhash64(F.col("doc_id"), F.lit("rise")), "doc_id")
    vectors = written(_vectors(feats, list(NAMES)).withColumn("part", F.row_number().over(deal) % PARTS), "toxic-vectors")
    grow = GBTClassifier(featuresCol=VEC, predictionCol=CLASS, labelCol="label", maxIter=trees, maxDepth=depth,
                         stepSize=0.2, seed=7, minInstancesPerNode=5).setProbabilityCol(PROB).setRawPredictionCol(RAW)
    model = Model(lexicons, grow.fit(vectors))

    def unseen(i: int) -> DataFrame:
        sub = Model(lexicons, grow.fit(vectors.where(F.col("part") != i)))
        return sub.margin(vectors.where(F.col("part") == i)).select("_tox_x", F.col("label").cast("double").alias("label"))
    if min(kinds.values()) > 1:
        points = unseen(0)
        for i in range(1, PARTS):
            points = points.unionByName(unseen(i))
    else:  # a label's only row cannot be both left out and learned from
        points = model.margin(vectors).select("_tox_x", F.col("label").cast("double").alias("label"))
    model.rise = IsotonicRegression(featuresCol="_tox_x", labelCol="label", predictionCol="_tox_rise").fit(
        written(points, "toxic-points"))
    return model


def classify(docs: DataFrame, labels: DataFrame, what: str = "toxic", mod: int = 4, held: int = 2,
             most: int = 20_000, at: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    scored = fit(docs, labels, what, mod, held, most).attach(docs.select("doc_id", "text"))
    score = F.col("_tox_score")
    return scored.select("doc_id", (crc_fold(F.col("doc_id"), mod) == held).alias("held_out"), score.alias("score"),
                         (score >= at).cast("int").alias("predicted"))
