"""Phrase collocation mining over suffixes of word sequences.

A suffix pointer is a place in a piece of text; its key is the next ``MOST``
words of the piece.  A multikey three-way quicksort splits pointers by one
word at a time into smaller, equal and larger ones; an equal part at depth d is
all occurrences of one phrase of d words, so its size is the phrase's count.
A part smaller than ``floor`` cannot hold a frequent phrase and is abandoned.

Routing: which leading words are worth following is settled corpus-wide, one
and then two words at a time, by counts that tasks add up locally before the
shuffle.  Pointers whose two leading words, or whose next two, are infrequent
go no further.  The rest are merged with equal ones of their slice, dealt to
tasks by their leading words, and sorted there to full depth.  Leading words
with very many pointers are dealt by the whole key instead; their parts are
counts of a share only, are never abandoned, and are added up afterwards.

Frequent words and pairs are told to the tasks as Bloom filters of a fixed
size (``BITS``), whatever the corpus: a word taken for frequent by mistake
costs time, and is dropped when its exact count is known.

A candidate's score is its count's ratio to what the cut into a first and a
rest would give if both were independent; the weakest cut counts.  A candidate
inside a longer one that occurs as often is dropped.

Defined results: null and empty texts have no words; a null lang is ``und``;
pieces and words keep whatever is not a separator; very long texts are cut up
by words inside a task, never shortened; rows that repeat an id or a text all
count; equal scores go by count, then by the phrase's bytes; an empty table
gives no rows.  Only text and lang are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.bytehash import mix
from quarry.llm.common import spread_join, written

#: words of the longest phrase
MOST = 5
#: bits of a Bloom filter
BITS = 1 << 25
#: bytes of text that a task handles at a time (one text at least)
SLICE = 4 << 20
#: pointers a task of the final sort should get
TASK_ROWS = 400_000
#: pointers of equal leading words above which they are dealt by the whole key
HOT_ROWS = 100_000

#: fixed values: what each byte is (0 word, 1 space, 2 end of a piece)
_CLASS = np.zeros(256, np.uint8)
_CLASS[[9, 32]] = 1
_CLASS[[10, 11, 12, 13, *b".,;:!?"]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    start = total = 0
    for i, n in enumerate(size):
        if i > start and total + n > SLICE:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)


class Words:
    """The words of a slice of texts, in order: ``lang`` and ``word`` are codes
    into ``langs`` and ``words``; ``joined`` says that a word and the next one
    lie in the same piece."""

    def __init__(self, batch: pa.RecordBatch):
        text = pc.fill_null(batch.column("text"), "").cast(pa.large_string())
        langs = pc.fill_null(batch.column("lang"), "und").dictionary_encode()
        ends, data = np.zeros(0, np.int64), np.zeros(0, np.uint8)
        if len(text):
            at = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
            ends = at[1:] - at[0]
            if ends[-1]:
                data = np.frombuffer(text.buffers()[2], np.uint8)[at[0]:at[-1]]
        kind = _CLASS[data]
        solid = kind == 0
        # a word also ends where its text does
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        inner = ends[ends < len(data)]
        first[inner] |= solid[inner]
        start = np.flatnonzero(first)
        kept = np.concatenate([[0], np.cumsum(solid)])
        offsets = np.append(kept[start], kept[-1]).astype(np.int64)
        letters = _LOWER[data[solid]]
        strings = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(letters))
        coded = strings.dictionary_encode()
        self.words, self.word = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        doc = np.searchsorted(ends, start, side="right")
        self.langs, self.lang = langs.dictionary, langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[doc]
        breaks = np.concatenate([[0], np.cumsum(kind == 2)])[start]
        n = len(start)
        self.joined = np.zeros(n, bool)
        self.joined[:-1] = (doc[1:] == doc[:-1]) & (breaks[1:] == breaks[:-1])

    def hashes(self) -> np.ndarray:
        """A hash of (lang, word) for each word."""
        w = np.array([xxhash.xxh64_intdigest(x.as_buffer()) for x in self.words], np.uint64)
        la = np.array([xxhash.xxh64_intdigest(x.as_buffer()) for x in self.langs], np.uint64)
        return word_hash(la, self.lang, w, self.word) if len(self.word) else np.zeros(0, np.uint64)


def word_hash(langs: np.ndarray, lang: np.ndarray, words: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(mix(langs)[lang] ^ words[word])


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(mix(first) + second)


def _bits(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (h & np.uint64(BITS - 1)).astype(np.int64), ((h >> np.uint64(32)) & np.uint64(BITS - 1)).astype(np.int64)


def _in(bloom: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether each hash may be in the filter (64-bit words of bits)."""
    out = np.ones(len(h), bool)
    for bit in _bits(h):
        out &= (bloom[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) > 0
    return out


def bloom_of(phrases: DataFrame) -> np.ndarray:
    """(lang, phrase) of one or two words -> their Bloom filter: BITS bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashed = []
            for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist()):
                la = np.array([xxhash.xxh64_intdigest(lang)], np.uint64)
                w = np.array([xxhash.xxh64_intdigest(x) for x in phrase.split(" ")], np.uint64)
                h = word_hash(la, np.zeros(len(w), np.int64), w, np.arange(len(w)))
                hashed.append(h[0] if len(h) == 1 else pair_hash(h[:1], h[1:])[0])
            bit = np.concatenate(_bits(np.array(hashed, np.uint64)))
            at, back = np.unique(bit >> 6, return_inverse=True)
            word = np.zeros(len(at), np.uint64)
            np.bitwise_or.at(word, back, np.uint64(1) << (bit & 63).astype(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(word.view(np.int64))], names=["at", "bits"])
    rows = phrases.select("lang", "phrase").mapInArrow(run, "at long, bits long")
    got = rows.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()  # BITS / 64 rows at most
    out = np.zeros(BITS // 64, np.uint64)
    out[got.column("at").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return out


def _counted(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of one of each kind of equal rows, and their numbers."""
    code = keys[0]
    for k in keys[1:]:
        code = np.unique(code, return_inverse=True)[1] * (int(k.max(initial=0)) + 2) + k + 1
    _, at, n = np.unique(code, return_index=True, return_counts=True)
    return at, n


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, phrase, f) of a slice's words; a null phrase for their sum."""
    for batch in batches:
        for part in _slices(batch):
            w = Words(part)
            at, n = _counted(w.lang, w.word)
            total = np.bincount(w.lang, minlength=len(w.langs))
            lang = pa.concat_arrays([w.langs.take(pa.array(w.lang[at])), w.langs])
            phrase = pa.concat_arrays([w.words.take(pa.array(w.word[at])), pa.nulls(len(w.langs), pa.large_string())])
            yield pa.RecordBatch.from_arrays([lang.cast(pa.string()), phrase.cast(pa.string()),
                                              pa.array(np.concatenate([n, total]).astype(np.int64))],
                                             names=["lang", "phrase", "f"])


def _count_pairs(words: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                w = Words(part)
                known = _in(words.value, w.hashes())
                i = np.flatnonzero(w.joined[:-1] & known[:-1] & known[1:]) if len(known) else np.zeros(0, np.int64)
                at, n = _counted(w.lang[i], w.word[i], w.word[i + 1])
                i = i[at]
                phrase = pc.binary_join_element_wise(*(w.words.take(pa.array(w.word[i + d])) for d in (0, 1)),
                                                     pa.scalar(" ", pa.large_string()))
                yield pa.RecordBatch.from_arrays([w.langs.take(pa.array(w.lang[i])).cast(pa.string()),
                                                  phrase.cast(pa.string()), pa.array(n.astype(np.int64))],
                                                 names=["lang", "phrase", "f"])
    return run


def _pointers(pairs: Broadcast):
    """Rows (lang, lead, phrase, f): each slice's different keys of three to
    MOST words, cut where the next pair is infrequent."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                w = Words(part)
                if not len(w.word):
                    continue
                h = w.hashes()
                on = np.zeros(len(h) + MOST, bool)  # a frequent pair begins here
                on[:len(h) - 1] = w.joined[:-1] & _in(pairs.value, pair_hash(h[:-1], h[1:]))
                i = np.flatnonzero(on[:-1] & on[1:])
                keys = np.full((len(i), MOST), -1, np.int64)
                keys[:, 0], keys[:, 1] = w.word[i], w.word[i + 1]
                more = np.ones(len(i), bool)
                for d in range(2, MOST):
                    more &= on[i + d - 1]
                    keys[more, d] = w.word[i[more] + d]
                at, n = _counted(w.lang[i], *keys.T)
                cols = [w.words.take(pa.array(np.where(k < 0, 0, k), mask=k < 0)) for k in keys[at].T]
                blank = pa.scalar(" ", pa.large_string())
                yield pa.RecordBatch.from_arrays(
                    [w.langs.take(pa.array(w.lang[i][at])).cast(pa.string()),
                     pc.binary_join_element_wise(*cols[:2], blank).cast(pa.string()),
                     pc.binary_join_element_wise(*cols, blank, null_handling="skip").cast(pa.string()),
                     pa.array(n.astype(np.int64))], names=["lang", "lead", "phrase", "f"])
    return run


def multikey_sort(keys: np.ndarray, weight: np.ndarray, floor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Three-way radix quicksort of key rows (codes; -1 ends a key): for each
    depth reached yields (a row of each equal part, the parts' weights, depth).

    All parts of a level are split at once: each takes the word of its middle
    pointer as pivot, pointers are dealt to smaller, equal and larger, and an
    equal part goes on to the next word.  A part whose weight is below its
    floor is abandoned.
    """
    ptr = np.arange(len(keys))
    part = np.zeros(len(keys), np.int64)
    depth = np.zeros(1, np.int64) if len(keys) else np.zeros(0, np.int64)
    while len(ptr):
        begin = np.searchsorted(part, np.arange(len(depth)))
        size = np.diff(np.append(begin, len(ptr)))
        pivot = keys[ptr[begin + size // 2], depth]
        side = np.sign(keys[ptr, depth[part]] - pivot[part]) + 1
        order = np.argsort(part * 3 + side, kind="stable")
        ptr, code = ptr[order], (part * 3 + side)[order]
        begin = np.flatnonzero(np.diff(code, prepend=-1))
        total = np.add.reduceat(weight[ptr], begin)
        code = code[begin]
        equal = code % 3 == 1
        keep = total >= floor[ptr[begin]]
        ended = equal & (pivot[code // 3] < 0)
        depth = depth[code // 3] + equal
        keep &= ~ended
        for d in np.unique(depth[keep & equal]):
            at = np.flatnonzero(keep & equal & (depth == d))
            yield ptr[begin[at]], total[at], int(d)
        keep &= depth < keys.shape[1]
        size = np.diff(np.append(begin, len(ptr)))
        ptr = ptr[np.repeat(keep, size)]
        part = np.repeat(np.arange(keep.sum()), size[keep])
        depth = depth[keep]


def _sort(floor: int):
    """Rows (lang, phrase, f, whole) of one task -> phrases of three and more
    words with their counts; ``whole`` leads are all here."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches), None) if (batches := list(batches)) else None
        if t is None or not t.num_rows:
            return
        t = t.combine_chunks()
        lang = t.column("lang").combine_chunks().dictionary_encode()
        split = pc.split_pattern(t.column("phrase").combine_chunks().cast(pa.large_string()), " ")
        words = split.flatten().dictionary_encode()
        size = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(len(size)), size)
        col = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        keys = np.full((len(size), MOST + 1), -1, np.int64)
        keys[:, 0] = lang.indices.to_numpy(zero_copy_only=False)
        keys[row, col + 1] = words.indices.to_numpy(zero_copy_only=False)
        whole = t.column("whole").to_numpy()
        # a share of a lead knows only part of its counts: nothing is abandoned there
        for shares, least in ((False, floor), (True, 1)):
            rows = np.flatnonzero(whole != shares)
            k = keys[rows]
            weight = t.column("f").to_numpy()[rows]
            for at, total, depth in multikey_sort(k, weight, np.full(len(rows), least)):
                if depth < 4:  # the lang and three words
                    continue
                cols = [words.dictionary.take(pa.array(k[at, d])) for d in range(1, depth)]
                yield pa.RecordBatch.from_arrays(
                    [lang.dictionary.take(pa.array(k[at, 0])),
                     pc.binary_join_element_wise(*cols, pa.scalar(" ", pa.large_string())).cast(pa.string()),
                     pa.array(total.astype(np.int64))], names=["lang", "phrase", "f"])
    return run


def frequent(docs: DataFrame, floor: int) -> tuple[DataFrame, DataFrame]:
    """Documents (text, lang) -> (lang, phrase, f) of all phrases of 1 to MOST
    words that occur ``floor`` times or more, and (lang, n), all words."""
    spark = docs.sparkSession
    rows = docs.select("text", "lang")
    row = "lang string, phrase string, f long"

    def summed(parts: DataFrame) -> DataFrame:
        return parts.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where((F.col("f") >= floor) | F.col("phrase").isNull())
    seen = written(summed(rows.mapInArrow(_count_words, row)), "words")
    words = seen.where(F.col("phrase").isNotNull())
    told = spark.sparkContext.broadcast(bloom_of(words))
    pairs = written(summed(rows.mapInArrow(_count_pairs(told), row)), "word-pairs")
    told = spark.sparkContext.broadcast(bloom_of(pairs))
    keys = written(rows.mapInArrow(_pointers(told), "lang string, lead string, phrase string, f long"), "phrase-pointers")
    n = keys.count()
    leads = keys.groupBy("lang", "lead").agg(F.count(F.lit(1)).alias("n"))
    # at most 100,000 leads can hold so many pointers, whatever the corpus
    hot = written(leads.where(F.col("n") > max(HOT_ROWS, n // 100_000)).select("lang", "lead", F.lit(True).alias("hot")), "hot-leads")
    dealt = keys.join(F.broadcast(hot), ["lang", "lead"], "left").withColumn("whole", F.col("hot").isNull())
    route = F.when(F.col("whole"), F.xxhash64("lang", "lead")).otherwise(F.xxhash64("lang", "phrase")).alias("route")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + n // TASK_ROWS)
    dealt = dealt.select("lang", "phrase", "f", "whole", route).repartition(tasks, "route").drop("route")
    deeper = written(summed(dealt.mapInArrow(_sort(floor), row)), "phrases")
    every = words.unionByName(pairs).unionByName(deeper)
    return written(every, "frequent-phrases"), seen.where(F.col("phrase").isNull()).select("lang", F.col("f").alias("n"))


def _phrase(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(docs: DataFrame, floor: int = 100, top: int = 2000) -> DataFrame:
    """Documents (text, lang) -> each lang's ``top`` phrases: lang, rank,
    phrase, a, l, r, n, score."""
    known, totals = frequent(docs, floor)
    words = F.split("phrase", " ")
    cand = known.withColumn("w", words).where(F.size("w") > 1)
    # a longer phrase that occurs as often: one word longer is enough, since counts fall with length
    m = F.size("w")
    longer = cand.where(m > 2).select("lang", F.explode(F.array(_phrase(F.col("w"), 1, m - 1), _phrase(F.col("w"), 2, m - 1)))
                                      .alias("phrase"), F.col("f").alias("over"))
    cand = (cand.select("lang", "phrase", F.col("f").alias("a"), F.lit(0).cast("long").alias("over"))
            .unionByName(longer.select("lang", "phrase", F.lit(None).cast("long").alias("a"), "over"))
            .groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.max("over").alias("over"))
            .where(F.col("over") < F.col("a")).drop("over"))
    # every cut's two sides, looked up among the frequent phrases
    cand = cand.withColumn("w", words)
    cuts = cand.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    sides = cuts.select("lang", F.col("phrase").alias("whole"), "a", "k", F.explode(F.array(
        F.struct(F.lit(True).alias("first"), _phrase(F.col("w"), F.lit(1), F.col("k")).alias("phrase")),
        F.struct(F.lit(False).alias("first"), _phrase(F.col("w"), F.col("k") + 1, F.size("w")).alias("phrase")))).alias("x"))
    sides = written(sides.select("lang", "whole", "a", "k", "x.*"), "phrase-sides")
    sides = spread_join(sides, known, "lang", "phrase")
    cut = sides.groupBy("lang", "whole", "a", "k").agg(F.max(F.when(F.col("first"), F.col("f"))).alias("l"),
                                                       F.max(F.when(~F.col("first"), F.col("f"))).alias("r"))
    big = lambda c: F.col(c).cast("decimal(19,0)")
    score = F.expr("cast(1000 as decimal(4,0)) * (x * y) div (u * v)")
    cut = (cut.join(totals, "lang").withColumns({"x": big("a"), "y": big("n"), "u": big("l"), "v": big("r")})
           .withColumn("score", score.cast("long")))
    best = cut.groupBy("lang", "whole", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    line = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (best.select("lang", F.col("whole").alias("phrase"), "a", "b.l", "b.r", "n", "b.score")
            .withColumn("rank", F.row_number().over(line)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
