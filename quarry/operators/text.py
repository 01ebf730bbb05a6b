"""Latent semantic analysis: tokens, stop words, TF-IDF, truncated SVD,
concept rankings, cosine queries.

TF-IDF is kept sparse and relational, (doc_id, term, tf, idf, tfidf), so
every step is a join or an aggregation; the SVD lays the same rows out in blocks
of documents and keeps doc ids on U (row identity is carried, never zipped).
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.tiles import normals

# tasks get these functions by value: executors need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOKEN_PATTERN = r"\p{L}+"


def tokens(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, words): lower-cased runs of letters in any script (punctuation,
    digits and spaces separate); a NULL text gives an empty list, the row is
    kept."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(TOKEN_PATTERN), 0)
    return docs.select(F.col(id_col).alias("doc_id"), words.alias("words"))


def remove_stop_words(tok: DataFrame, stop_words: list[str] | None = None) -> DataFrame:
    """StopWordsRemover (English default list) on the words column."""
    r = StopWordsRemover(inputCol="words", outputCol="filtered")
    if stop_words is not None:
        r = r.setStopWords(stop_words)
    return r.transform(tok).select("doc_id", F.col("filtered").alias("words"))


def _counted(tok: DataFrame) -> DataFrame:
    """(doc_id, term, tf) within each row: the runs of its sorted words."""
    s, starts = F.col("_s"), F.col("_starts")
    first = F.filter(F.sequence(F.lit(0), F.size(s) - 1),
                     lambda i: (i == 0) | (F.get(s, i) != F.get(s, F.greatest(i - 1, F.lit(0)))))
    runs = F.transform(starts, lambda i, k: F.struct(
        F.get(s, i).alias("term"), (F.coalesce(F.get(starts, k + 1), F.size(s)) - i).cast("long").alias("tf")))
    return (tok.where(F.size("words") > 0).select("doc_id", F.sort_array("words").alias("_s"))
            .withColumn("_starts", first).select("doc_id", F.explode(runs).alias("x")).select("doc_id", "x.term", "x.tf"))


def term_counts(tok: DataFrame) -> DataFrame:
    """(doc_id, term, tf).  Words are counted inside their row; only rows that
    share a doc_id with others (found by a pass over the ids alone) are shuffled."""
    n = tok.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    again = n.where("n > 1").select(F.col("doc_id").alias("_d")).checkpoint()
    if again.limit(1).count() == 0:
        return _counted(tok)
    same = F.col("doc_id").eqNullSafe(F.col("_d"))
    several = _counted(tok.join(again, same, "left_semi")).groupBy("doc_id", "term").agg(F.sum("tf").alias("tf"))
    return _counted(tok.join(again, same, "left_anti")).unionByName(several)


def vocabulary(tf: DataFrame, size: int) -> DataFrame:
    """Top ``size`` terms by corpus frequency (ties by term), with index 0..size-1.
    The limit is the feature here (a top-k vocabulary)."""
    tot = tf.groupBy("term").agg(F.sum("tf").alias("total"))
    top = tot.orderBy(F.col("total").desc(), F.col("term").asc()).limit(size)
    w = Window.partitionBy(F.lit(0)).orderBy(F.col("total").desc(), F.col("term").asc())
    return top.withColumn("term_idx", (F.row_number().over(w) - 1).cast("int"))  # <= size rows


def every_term(tf: DataFrame) -> DataFrame:
    """The whole vocabulary (term, term_idx), numbered in the terms' order."""
    from quarry.operators.recommend import item_index
    return (item_index(tf.select(F.col("term").alias("item")))
            .select(F.col("item").alias("term"), F.col("idx").cast("int").alias("term_idx")))


#: terms of a vocabulary that may be broadcast (about 100 bytes each)
BROADCAST_TERMS = 100_000


def tfidf(tf: DataFrame, vocab: DataFrame, n_docs) -> DataFrame:
    """(doc_id, term, term_idx, tf, idf, tfidf) with idf = ln((m + 1) / (df + 1)).
    A vocabulary of more than BROADCAST_TERMS terms is joined by shuffle: its
    rows, with their idf, meet the counts once and are what is held in memory."""
    def idf(df_):
        return df_.select("term", F.log((F.lit(n_docs).cast("double") + 1.0) / (F.col("df").cast("double") + 1.0)).alias("idf"))
    per_term = lambda t: t.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    terms = vocab.select("term", "term_idx")
    if vocab.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS:
        t = tf.join(F.broadcast(terms), "term")
        t = t.join(F.broadcast(idf(per_term(t))), "term")
    else:
        t = tf.join(terms.join(idf(per_term(tf)), "term").hint("shuffle_hash"), "term")
    return t.withColumn("tfidf", F.col("tf") * F.col("idf"))


def normalize_rows(tfidf_rows: DataFrame, value: str = "tfidf") -> DataFrame:
    """Divide each doc's weights by the doc's L2 norm (zero rows stay 0)."""
    norm = tfidf_rows.groupBy("doc_id").agg(F.sqrt(F.sum(F.col(value) * F.col(value))).alias("norm"))
    return (tfidf_rows.join(norm, "doc_id")
            .withColumn("unit", F.when(F.col("norm") > 0, F.col(value) / F.col("norm")).otherwise(0.0)))


def cosine_to(unit: DataFrame, query_doc) -> DataFrame:
    """(doc_id, cosine) of every doc against one query doc: the query's few
    terms are joined against the term column, linear in the corpus."""
    q = unit.where(F.col("doc_id") == query_doc).select("term", F.col("unit").alias("q"))
    return (unit.join(F.broadcast(q), "term")   # one doc's terms: bounded by the vocabulary
            .groupBy("doc_id").agg(F.sum(F.col("unit") * F.col("q")).alias("cosine")))


def _apply(rows: DataFrame, on: str, to: str, table: DataFrame, width: int) -> DataFrame:
    """Matrix (on, to, a) times the tall matrix (on, q): (to, y).  The plain
    product by a join, to compare those of the blocks with."""
    sums = [F.sum(F.col("a") * F.get(F.col("q"), F.lit(j))).alias(f"y{j}") for j in range(width)]
    out = rows.join(table, on).groupBy(to).agg(*sums)
    return out.select(to, F.array(*[F.coalesce(f"y{j}", F.lit(0.0)) for j in range(width)]).alias("y")).checkpoint()


#: bytes of the term vectors that a task adds up
TERM_MATRIX = 64 << 20
#: entries of a block of documents
ENTRIES = 2_000_000
#: vectors a document keeps; beyond that the best half goes on
COLUMNS = 128


def _doc_chunks(batches):
    """Entries sorted by document, in chunks of whole documents: (batch, first
    entry of each document)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    held, n = [], 0

    def starts(t):
        doc = t.column("doc_id")
        v, null = doc.fill_null(0).to_numpy(), pc.is_null(doc).to_numpy(zero_copy_only=False)
        return np.flatnonzero(np.r_[True, (v[1:] != v[:-1]) | (null[1:] != null[:-1])])
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= ENTRIES:
            t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            at = starts(t)
            if len(at) > 1:   # the last document may go on
                yield t.slice(0, at[-1]), at[:-1]
                t = t.slice(at[-1])
            held, n = [t], t.num_rows
    if held:
        t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        yield t, starts(t)


def _blocks(batches):
    """A partition's entries as blocks of documents: where each document's
    entries start, each entry's place among the block's terms, and its value."""
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext
    task = TaskContext.get().partitionId()
    for k, (t, at) in enumerate(_doc_chunks(batches)):
        terms, place = np.unique(t.column("term_idx").to_numpy(), return_inverse=True)
        docs = pa.ListArray.from_arrays(pa.array([0, len(at)], pa.int32()), t.column("doc_id").take(pa.array(at)))
        blobs = (at.astype(np.int64), place.astype(np.int32), t.column("a").to_numpy(), terms.astype(np.int32))
        yield pa.RecordBatch.from_arrays([pa.array([f"{task}-{k}"]), docs, *[pa.array([x.tobytes()], pa.binary()) for x in blobs]],
                                         names=["name", "docs", "starts", "place", "a", "terms"])


def _term_lists(parts: list[int]):
    """A block's terms for each part of the terms."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            for block, x in zip(batch.column("block").to_pylist(), batch.column("terms").to_pylist()):
                terms = np.frombuffer(x, np.int32)
                of = terms % len(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(parts), pa.int32()), pa.array(parts, pa.int32()),
                     pa.array([terms[of == p].tobytes() for p in range(len(parts))], pa.binary())], names=["block", "part", "terms"])
    return run


def _shared(t):
    """One part of the terms: each block's terms that other blocks have too, and
    their places among all such terms of the part."""
    import numpy as np
    import pyarrow as pa
    lists = [np.frombuffer(x, np.int32) for x in t.column("terms").to_pylist()]
    every, n = np.unique(np.concatenate(lists), return_counts=True)
    every = every[n > 1]
    own = [x[np.isin(x, every, assume_unique=True)] for x in lists]
    return pa.table({"block": t.column("block"), "part": t.column("part"),
                     "terms": pa.array([x.tobytes() for x in own], pa.binary()),
                     "at": pa.array([np.searchsorted(every, x).astype(np.int32).tobytes() for x in own], pa.binary()),
                     "n": pa.array([len(every)] * len(own), pa.int32())})


_MESSAGE = "block int, part int, number int, x binary, gram binary"
#: numbers of messages that are no vectors of documents (1, 2, ..)
SUMS, LISTS = 0, -1


def _message(block: list, part: list, number: int, x: list, gram: list):
    import pyarrow as pa
    return pa.table([pa.array(block, pa.int32()), pa.array(part, pa.int32()), pa.array([number] * len(block), pa.int32()),
                     pa.array(x, pa.binary()), pa.array(gram, pa.binary())], names=["block", "part", "number", "x", "gram"])


class _Docs:
    """A block of documents inside a task, with its terms that others have too (their
    places by part, from the rows of number LISTS)."""

    def __init__(self, row, right=None):
        import numpy as np
        for name, kind in {"starts": np.int64, "place": np.int32, "a": np.float64, "terms": np.int32}.items():
            setattr(self, name, np.frombuffer(row.column(name)[0].as_py(), kind))
        self.place = self.place.astype(np.intp)
        self.block = row.column("block")[0].as_py()
        self.lengths = np.diff(np.append(self.starts, len(self.a)))
        if right is not None:
            rows = list(zip(*(right.column(c).to_pylist() for c in ("number", "part", "x"))))
            self.at = {p: np.searchsorted(self.terms, np.frombuffer(x, np.int32)) for n, p, x in rows if n == LISTS}
            self.sums = {p: x for n, p, x in rows if n == SUMS}
            own = [np.frombuffer(x).reshape(len(self.starts), -1) for n, _, x in sorted((r for r in rows if r[0] > 0), key=lambda r: r[0])]
            self.vectors = np.hstack(own)
            alone = np.ones(len(self.terms), bool)
            for at in self.at.values():
                alone[at] = False
            self.alone = np.flatnonzero(alone)

    def terms_of(self, q):
        """Documents' vectors times A: those of the block's terms."""
        import numpy as np
        out = np.empty((len(self.terms), q.shape[1]))
        for j, x in enumerate(q.T):
            out[:, j] = np.bincount(self.place, self.a * np.repeat(x, self.lengths), len(out))
        return out

    def alone_of(self, q):
        """Those of the terms that the block has alone."""
        import numpy as np
        to = np.full(len(self.terms), -1)
        to[self.alone] = np.arange(len(self.alone))
        to = to[self.place]
        some = np.flatnonzero(to >= 0)
        doc, to, a = np.searchsorted(self.starts, some, side="right") - 1, to[some], self.a[some]
        out = np.empty((len(self.alone), q.shape[1]))
        for j, x in enumerate(q.T):
            out[:, j] = np.bincount(to, a * x[doc], len(out))
        return out

    def docs_of(self, z):
        """Terms' vectors times A: those of the documents."""
        import numpy as np
        out = np.empty((len(self.starts), z.shape[1]))
        for j, x in enumerate(np.ascontiguousarray(z.T)):
            out[:, j] = np.add.reduceat(self.a * x[self.place], self.starts)
        return out


def _first(width: int, n_terms: int, seed: int):
    """A times random vectors of the terms; unit vectors when there are no more terms."""
    def run(batches):
        import numpy as np
        for batch in batches:
            for i in range(batch.num_rows):
                b = _Docs(batch.slice(i, 1))
                if width == n_terms:
                    z = (b.terms[:, None] == np.arange(width)).astype(float)
                else:
                    z = normals(b.terms.astype(np.int64), 0, width, seed)
                x = b.docs_of(z)
                yield from _message([b.block], [None], 1, [x.tobytes()], [(x.T @ x).tobytes()]).to_batches()
    return run


def _down(mix):
    """The documents' mixed vectors times A, to the parts of the terms."""
    def run(left, right):
        b = _Docs(left, right)
        z = b.terms_of(b.vectors @ mix)
        n = len(b.at)
        return _message([b.block] * n, list(b.at), SUMS, [z[at].tobytes() for at in b.at.values()], [None] * n)
    return run


def _added(left, right):
    """(links, total of each shared term of a part)."""
    import numpy as np
    at = {b: np.frombuffer(x, np.int32) for b, x in zip(left.column("block").to_pylist(), left.column("at").to_pylist())}
    got = {b: np.frombuffer(x) for b, x in zip(right.column("block").to_pylist(), right.column("x").to_pylist())}
    width = max((len(x) // len(at[b]) for b, x in got.items() if len(at[b])), default=0)
    total = np.zeros((left.column("n")[0].as_py(), width))
    for b in sorted(got):   # in one order, so that sums agree
        if len(at[b]):
            total[at[b]] += got[b].reshape(-1, width)
    return at, total


def _back(left, right):
    """Totals of the shared terms, to the blocks that have them."""
    at, total = _added(left, right)
    blocks = sorted(at)
    part = left.column("part")[0].as_py()
    return _message(blocks, [part] * len(blocks), SUMS, [total[at[b]].tobytes() for b in blocks], [None] * len(blocks))


def _up(mix, number: int):
    """New vectors of the documents, with their products with all so far."""
    def run(left, right):
        import numpy as np
        b = _Docs(left, right)
        z, x = np.empty((len(b.terms), mix.shape[1])), b.vectors
        z[b.alone] = b.alone_of(x @ mix)
        for p, at in b.at.items():
            z[at] = np.frombuffer(b.sums[p]).reshape(-1, mix.shape[1])
        new = b.docs_of(z)
        return _message([b.block], [None], number, [new.tobytes()], [(np.hstack([x, new]).T @ new).tobytes()])
    return run


def _mixed(mix):
    """The documents' vectors replaced by a mix of them."""
    def run(left, right):
        b = _Docs(left, right)
        x = b.vectors @ mix
        return _message([b.block], [None], 1, [x.tobytes()], [(x.T @ x).tobytes()])
    return run


_TERMS = "terms binary, x binary"


def _terms_table(terms, x):
    import pyarrow as pa
    return pa.table([pa.array([terms.tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary())], names=["terms", "x"])


def _alone_terms(mix):
    def run(left, right):
        b = _Docs(left, right)
        return _terms_table(b.terms[b.alone], b.alone_of(b.vectors @ mix))
    return run


def _shared_terms(left, right):
    import numpy as np
    at, total = _added(left, right)
    terms = np.empty(len(total), np.int32)
    for b, x in zip(left.column("block").to_pylist(), left.column("terms").to_pylist()):
        terms[at[b]] = np.frombuffer(x, np.int32)
    return _terms_table(terms, total)


def _largest(k: int):
    """The entry of the largest size (ties: the smaller term) of each concept in
    each row's terms."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            for terms, x in zip(batch.column("terms").to_pylist(), batch.column("x").to_pylist()):
                terms, x = np.frombuffer(terms, np.int32), np.frombuffer(x).reshape(-1, k)
                if len(terms):
                    best = [np.lexsort((terms, -np.round(np.abs(c), 12)))[0] for c in x.T]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(range(k), pa.int32()), pa.array(terms[best]), pa.array(x[best, range(k)])],
                        names=["concept", "term_idx", "weight"])
    return run


def _term_rows(sign):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        k = len(sign)
        for batch in batches:
            for terms, x in zip(batch.column("terms").to_pylist(), batch.column("x").to_pylist()):
                terms, x = np.frombuffer(terms, np.int32), np.frombuffer(x).reshape(-1, k) * sign
                for lo in range(0, len(terms), 10_000):
                    n = len(terms[lo:lo + 10_000])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(terms[lo:lo + n], k)), pa.array(np.tile(np.arange(k, dtype=np.int32), n)),
                         pa.array(x[lo:lo + n].ravel())], names=["term_idx", "concept", "weight"])
    return run


def _doc_rows(mix):
    def run(left, right):
        import numpy as np
        import pyarrow as pa
        u = _Docs(left, right).vectors @ mix
        n, k = u.shape
        docs = left.column("docs").combine_chunks().flatten()
        return pa.table([docs.take(pa.array(np.repeat(np.arange(n), k))), pa.array(np.tile(np.arange(k, dtype=np.int32), n)),
                         pa.array(u.ravel())], names=["doc_id", "concept", "weight"])
    return run


class _Blocks:
    """The sparse matrix A (documents by terms) in blocks of documents, written once.

    A term that one block has alone never leaves it.  For the others a block sends
    its sums to the term's part, where they are added, and the part sends
    the totals back: a product by A and its transpose shuffles a vector per
    block and shared term, and no entry of the matrix."""

    def __init__(self, a: DataFrame, n_terms: int, width: int):
        from quarry.session import even_keys, handed_off, last_use
        self.spark = spark = a.sparkSession
        self.id = a.schema["doc_id"].dataType.simpleString()
        shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))

        def kept(df, key):
            # cogroups read it where it is
            return last_use(df.repartition(shuffle, key).sortWithinPartitions(key), lambda x: x.checkpoint())
        made, remove = handed_off(a.repartition("doc_id").sortWithinPartitions("doc_id").mapInArrow(
            _blocks, f"name string, docs array<{self.id}>, starts binary, place binary, a binary, terms binary"), "svd-blocks")
        names = sorted(r["name"] for r in made.select("name").collect())   # a name a block
        self.empty = not names
        if not self.empty:
            per = max(spark.sparkContext.defaultParallelism, -(-n_terms * width * 8 // max(1, TERM_MATRIX)))
            parts = min(n_terms, per)
            even = even_keys(spark, shuffle, max(len(names), parts))
            number = spark.createDataFrame(list(zip(names, even)), "name string, block int")
            self.laid = kept(made.join(F.broadcast(number), "name").drop("name"), "block")   # a row a block
            lists = self.laid.select("block", "terms").mapInArrow(_term_lists(even[:parts]), "block int, part int, terms binary")
            self.links = kept(lists.groupBy("part").applyInArrow(_shared, "block int, part int, terms binary, at binary, n int"), "part")
            none = F.lit(None).cast("binary")
            self.lists = self.links.select("block", "part", F.lit(LISTS).alias("number"), F.col("terms").alias("x"), none.alias("gram"))
        remove()

    def _by_block(self, rows: DataFrame, run, schema: str = _MESSAGE) -> DataFrame:
        return self.laid.groupBy("block").cogroup(rows.unionByName(self.lists).groupBy("block")).applyInArrow(run, schema)

    def _by_part(self, rows: DataFrame, run, schema: str = _MESSAGE) -> DataFrame:
        return self.links.groupBy("part").cogroup(rows.groupBy("part")).applyInArrow(run, schema)

    def _written(self, df: DataFrame):
        """A table of new vectors and the sum of the blocks' products."""
        import numpy as np
        from quarry.session import last_use
        new = last_use(df, lambda x: x.checkpoint())
        grams = [np.frombuffer(r["gram"]) for r in new.select("block", "gram").orderBy("block").collect()]   # a small matrix a block
        return new, sum(grams[1:], grams[0])

    def first(self, width: int, n_terms: int, seed: int):
        new, gram = self._written(self.laid.mapInArrow(_first(width, n_terms, seed), _MESSAGE))
        self.state = new
        return gram.reshape(-1, width)

    def product(self, mix, number: int):
        """A times its transpose times the mixed vectors, kept as further vectors."""
        sent = self._by_block(self.state, _down(mix))
        rows = self._by_part(sent, _back).unionByName(self.state)
        new, gram = self._written(self._by_block(rows, _up(mix, number)))
        self.state = self.state.unionByName(new)
        return gram.reshape(-1, mix.shape[1])

    def mix(self, mix):
        self.state, gram = self._written(self._by_block(self.state, _mixed(mix)))
        return gram.reshape(-1, mix.shape[1])

    def docs(self, mix) -> DataFrame:
        return self._by_block(self.state, _doc_rows(mix), f"doc_id {self.id}, concept int, weight double")

    def terms(self, mix) -> DataFrame:
        """(terms, x): rows of many terms' vectors, A transposed times the mixed ones."""
        from quarry.session import last_use
        alone = self._by_block(self.state, _alone_terms(mix), _TERMS)
        met = self._by_part(self._by_block(self.state, _down(mix)), _shared_terms, _TERMS)
        return last_use(alone.unionByName(met), lambda x: x.checkpoint())


def _ritz(blocks: _Blocks, first, k: int, tol: float):
    """The leading eigenvalues of A times its transpose and what mixes the kept
    vectors to theirs: block Lanczos with all vectors orthogonalised against all
    others, restarted with the best half when a document keeps more than COLUMNS."""
    import numpy as np

    def orthonormal(r, gram, scale, least=1e-6):
        d, w = np.linalg.eigh(r.T @ gram @ r)
        keep = d > least ** 2 * scale
        return r @ w[:, keep] / np.sqrt(d[keep]), (w[:, keep] * np.sqrt(d[keep])).T
    gram = first
    last, _ = orthonormal(np.eye(len(gram)), gram, gram.diagonal().max(initial=1e-300))
    basis, h, tables = last, np.zeros((0, 0)), 1
    while last.shape[1]:
        tables += 1
        got, n, w = blocks.product(last, tables), len(gram), last.shape[1]
        gram = np.block([[gram, got[:n]], [got[:n].T, (got[n:] + got[n:].T) / 2]])
        basis = np.vstack([basis, np.zeros((w, basis.shape[1]))])
        c = basis.T @ gram[:, n:]
        m = len(c) - w
        h = np.block([[h, c[:m]], [c[:m].T, (c[m:] + c[m:].T) / 2]])
        rest = np.vstack([np.zeros((n, w)), np.eye(w)])
        for _ in range(2):
            rest = rest - basis @ (basis.T @ gram @ rest)
        last, over = orthonormal(rest, gram, gram[n:, n:].diagonal().max())
        value, y = np.linalg.eigh(h)
        value, y = value[::-1], y[:, ::-1]
        off = np.linalg.norm(over @ y[-w:, :k], axis=0)
        if len(value) >= k and (off <= tol * value[0]).all():
            break
        if last.shape[1] and basis.shape[1] + 2 * last.shape[1] > COLUMNS:
            best = min(basis.shape[1], max(2 * k, COLUMNS // 2))
            gram = blocks.mix(np.hstack([basis @ y[:, :best], last]))
            tables, h = 1, np.diag(value[:best])
            basis = np.eye(len(gram))
            last = basis[:, best:]
        elif last.shape[1]:
            basis = np.hstack([basis, last])
    if not len(h):
        return np.zeros(0), basis
    return value[:k], basis[:, :len(h)] @ y[:, :k]


def svd(tfidf_rows: DataFrame, n_terms: int, k: int, oversample: int = 4, tol: float = 1e-8, seed: int = 11):
    """Truncated SVD of the doc x term TF-IDF matrix A (rows keyed by doc id),
    whatever the number of terms: block Lanczos on A times its transpose.

    A block of k + ``oversample`` vectors of the documents, A times random vectors
    of the terms, is multiplied by A transposed and by A in turn, inside
    tasks that hold a block of documents (see ``_Blocks``); the leading k
    values are those of all vectors so far together, and rounds end when what they
    leave over is at most ``tol`` of the largest.  A vocabulary no
    wider than the block starts from the unit vectors, which need no rounds.
    Documents and terms stay in tables; the driver sees matrices of at most COLUMNS
    columns.  Each singular vector's sign is fixed so that its
    largest V entry is positive (ties: the smaller term).

    Returns (U (doc_id, concept, weight), V (term_idx, concept, weight),
    singular values); values below 1e-6 of the largest are left out.
    """
    import numpy as np
    from quarry.session import shared_dir
    spark = tfidf_rows.sparkSession
    shared_dir(spark)
    a = tfidf_rows.select("doc_id", "term_idx", F.col("tfidf").cast("double").alias("a"))
    none = spark.createDataFrame([], "term_idx int, concept int, weight double")
    no_docs = a.select("doc_id", F.lit(0).alias("concept"), F.col("a").alias("weight")).limit(0)
    width = min(n_terms, k + oversample)
    blocks = _Blocks(a, n_terms, width) if width else None
    if blocks is None or blocks.empty:
        return no_docs, none, []
    value, mix = _ritz(blocks, blocks.first(width, n_terms, seed), k, tol)
    s = np.sqrt(np.maximum(value, 0.0))
    keep = s > 1e-6 * s.max(initial=1e-300)
    s, mix = s[keep], mix[:, keep]
    if not len(s):
        return no_docs, none, []
    v = blocks.terms(mix / s)
    tops = v.mapInArrow(_largest(len(s)), "concept int, term_idx int, weight double")
    first = tops.groupBy("concept").agg(F.max_by("weight", F.struct(F.round(F.abs("weight"), 12), -F.col("term_idx"))).alias("w"))
    sign = np.ones(len(s))
    for row in first.collect():  # k rows
        sign[row["concept"]] = -1.0 if row["w"] < 0 else 1.0
    return (blocks.docs(mix * sign), v.mapInArrow(_term_rows(sign), "term_idx int, concept int, weight double"),
            [float(x) for x in s])


def top_per_concept(weights: DataFrame, key: str, n: int, salts: int = 64) -> DataFrame:
    """Top ``n`` rows per concept by weight (ties by key).

    A concept spans every document, so a plain per-concept window would sort
    the whole corpus in one task.  Stage one keeps the top n inside each
    (concept, hash(key) mod salts) slice; stage two ranks the <= salts * n
    survivors per concept.
    """
    order = [F.col("weight").desc(), F.col(key).asc()]
    salt = F.pmod(F.xxhash64(F.col(key)), F.lit(salts))
    w1 = Window.partitionBy("concept", salt).orderBy(*order)
    pre = weights.withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= n).drop("_r")
    w2 = Window.partitionBy("concept").orderBy(*order)
    return pre.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= n)
