"""Quality score by compression: a zstandard dictionary is built from good and
one from bad labelled texts; a text that the bad dictionary compresses worse
than the good one is likely good.  The size difference over the text's length
becomes a probability by isotonic regression.

Whole texts are scored, in pieces of about ``PIECE`` bytes that each start from
the dictionary alone, so that a long text is not judged by what it has taught the
compressor itself.

Bounds (documented parameters): at most ``most`` labelled documents outside
the held-out fold are read for the fit; half of them give the calibration,
the others the dictionaries, from at most ``DICT_DOCS`` documents of each
label of at most ``DICT_DOC_BYTES`` bytes.

Defined results: null and empty texts have difference 0 and its calibrated
score; without labels of both kinds every text scores the common label (0
without any); rows sharing an id are scored each by its own text; an empty
table gives no rows.  Only doc_id and text are read of the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import crc_fold, isotonic, labelled, written

PIECE = 256
DICT_BYTES = 64 << 10
DICT_DOCS = 1500
DICT_DOC_BYTES = 32 << 10


def build_dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary; the texts themselves where there are too few to
    train one."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, texts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(texts)[-DICT_BYTES:]


class Sizer:
    """Compressed sizes under the good and the bad dictionary."""

    def __init__(self, good: bytes, bad: bytes, level: int = 3):
        self.both = [self._with(d, level) for d in (good, bad)]

    @staticmethod
    def _with(raw: bytes, level: int) -> zstandard.ZstdCompressor:
        kind = {"dict_data": zstandard.ZstdCompressionDict(raw)} if raw else {}
        return zstandard.ZstdCompressor(level=level, write_content_size=False, write_checksum=False,
                                        write_dict_id=False, **kind)

    def difference(self, text: str | None) -> float:
        """(bad size - good size) / length: higher is better."""
        data = (text or "").encode("utf-8", "surrogatepass")
        if not data:
            return 0.0
        n = max(1, round(len(data) / PIECE))  # a short rest goes with the last piece
        cuts = [(i * PIECE, (i + 1) * PIECE if i < n - 1 else len(data)) for i in range(n)]
        good, bad = (sum(len(c.compress(data[a:b])) for a, b in cuts) for c in self.both)
        return (bad - good) / len(data)


def _score(good: bytes, bad: bytes, steps: list[float], values: list[float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizer = Sizer(good, bad)
        for batch in batches:
            x = np.array([sizer.difference(t.as_py()) for t in batch.column(1)], dtype=np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(x), pa.array(np.interp(x, steps, values))],
                names=["doc_id", "difference", "score"])
    return run


def fit(docs: DataFrame, labels: DataFrame, what: str = "quality", mod: int = 5, held: int = 0,
        most: int = 20_000) -> tuple[bytes, bytes, list[float], list[float]]:
    """The two dictionaries and the calibration steps."""
    rows = written(labelled(docs, labels, what, mod, held, most), "quality-sample")

    def sample(label: int) -> bytes:
        own = (rows.where((F.col("pick") < 50) & (F.col("label") == label) & (F.octet_length("text") <= DICT_DOC_BYTES))
               .select("doc_id", "text").orderBy("doc_id", "text").limit(DICT_DOCS).collect())
        return build_dictionary([t for t in ((r["text"] or "").encode("utf-8", "surrogatepass") for r in own) if t])
    good, bad = sample(1), sample(0)
    if not good or not bad:
        return good, bad, *isotonic(rows.select(F.lit(0.0).alias("x"), "label").distinct())
    rest = rows.where("pick >= 50").select("label", "text")
    points = rest.mapInArrow(_score(good, bad, [0.0], [0.0]), "label int, x double, score double")
    return good, bad, *isotonic(points.select("x", "label"))


def score(docs: DataFrame, model: tuple[bytes, bytes, list[float], list[float]]) -> DataFrame:
    """Documents (doc_id, text) -> doc_id, difference, score."""
    return docs.select("doc_id", "text").mapInArrow(_score(*model), "doc_id long, difference double, score double")


def classify(docs: DataFrame, labels: DataFrame, what: str = "quality", mod: int = 5, held: int = 0,
             most: int = 20_000, at: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted, difference of every document."""
    scored = score(docs, fit(docs, labels, what, mod, held, most))
    return scored.select("doc_id", (crc_fold(F.col("doc_id"), mod) == held).alias("held_out"), "score",
                         (F.col("score") >= at).cast("int").alias("predicted"), "difference")
