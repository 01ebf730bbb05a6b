"""Cross-tokenizer alignment: which tokens of two tokenizers end together.

A text is encoded by a byte-level BPE (A) and by a sentencepiece model (B).
Byte offsets where a token of each ends cut both sequences into groups; the
tokens that end there are a link.  Corpus-wide counts of linked id pairs tell
how usual each link is.

Method: the ends of both sequences are compared along a diagonal.  A lane at
(i, j), with index shift j - i, compares the next 1, 2, 4, .. ends of both
sides at that shift and jumps over as many as agree; where they stop agreeing,
the side that lags is moved on until two ends meet, which closes the irregular
group and gives the new shift.  Many lanes advance together: the tokens of a
slice of documents are cut into lanes of about ``LANE`` tokens, each of which
starts behind a common end (the end of a document is one).

Scale: one pass encodes and aligns, and writes each document's digests and
links, and each task's partial pair counts; a second pass over the written
links, without the texts, looks the counts up.  Of two tokens that end
together one is a suffix of the other, so there are at most as many different
pairs as the tokens of both vocabularies have bytes together (times equal
pieces): the table of pair counts has that bound whatever the corpus, and may
go to every task.  Nothing else leaves a task but its own rows.

Defined results: null and empty texts, and texts that either side does not
give back byte for byte, have no tokens (zeros, an empty digest); rows that
repeat an id or a text get a row each; ties for a B id's highest count all
count; a text is encoded whole, however long (its task must hold it); an empty
table gives no rows.  Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import written

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
#: bytes of text that a task handles at a time (one text at least)
SLICE = 1 << 20
#: links looked up together
LINKS = 1 << 18
#: A tokens of a lane
LANE = 256
#: fixed value: how the byte-level vocabulary splits a text before its merges
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: texts of these characters alone split alike under every Unicode version
_PLAIN = re.compile("[\x00-ſ‘-‟…]*")


def byte_letters() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: itself
    where it prints, else the next free one from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


class ByteBpe:
    """Side A.  Merges of a byte-level BPE are ranked by id, so its vocabulary
    alone encodes; the tokenizer's own file decides on characters whose class
    (letter, digit, space) differs between Unicode versions."""

    def __init__(self, path: str):
        import tiktoken
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["id"] for t in spec.get("added_tokens", ()) if t.get("special")}
        letters = byte_letters()
        self.path, self.whole = path, None
        self.bytes = [b""] * (1 + max(spec["model"]["vocab"].values()))
        for piece, i in spec["model"]["vocab"].items():
            if i not in special:
                self.bytes[i] = bytes(letters[c] for c in piece)
        self.fast = tiktoken.Encoding("byte_bpe", pat_str=SPLIT, special_tokens={},
                                      mergeable_ranks={b: i for i, b in enumerate(self.bytes) if b})

    def encode(self, text: str) -> np.ndarray:
        if _PLAIN.fullmatch(text):
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        if self.whole is None:
            from tokenizers import Tokenizer
            self.whole = Tokenizer.from_file(self.path)
            self.whole.encode_special_tokens = True
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.int64)


class Pieces:
    """Side B."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [bytes([int(self.model.id_to_piece(i)[3:-1], 16)]) if self.model.is_byte(i)
                      else b"" if self.model.is_control(i) or self.model.is_unknown(i)
                      else self.model.id_to_piece(i).replace("▁", " ").encode()
                      for i in range(self.model.get_piece_size())]

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text), np.int64)


def possible_pairs(a: list[bytes], b: list[bytes]) -> int:
    """How many id pairs can end together: those of which one is a suffix of
    the other."""
    def by_bytes(side):
        out: dict[bytes, int] = {}
        for x in side:
            out[x] = out.get(x, 0) + 1
        return out
    of_a, of_b = by_bytes(a), by_bytes(b)
    return (sum(of_a.get(y[i:], 0) for y in b for i in range(len(y)))
            + sum(of_b.get(x[i:], 0) for x in a for i in range(1, len(x))))


def _meet(ea: np.ndarray, eb: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Move the lagging side of each (i, j) on until their ends are equal."""
    i, j = i.copy(), j.copy()
    open_ = np.flatnonzero(ea[i] != eb[j])
    while len(open_):
        x, y = ea[i[open_]], eb[j[open_]]
        i[open_] += x < y
        j[open_] += y < x
        open_ = open_[ea[i[open_]] != eb[j[open_]]]
    return i, j


def common_ends(ea: np.ndarray, eb: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, np.ndarray]:
    """The indices (in A, in B) of the ends that two rising sequences share,
    by diagonal run skipping.  Their last ends must be equal."""
    if not len(ea):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # lanes: behind the first common end at or after every lane-th token
    seed = np.arange(lane - 1, len(ea), lane)
    ci, cj = _meet(ea, eb, seed, np.minimum(np.searchsorted(eb, ea[seed]), len(eb) - 1))
    ci = np.unique(ci)
    cj = np.searchsorted(eb, ea[ci])
    i = np.concatenate([[0], ci + 1])
    j = np.concatenate([[0], cj + 1])
    stop = np.concatenate([ci + 1, [len(ea)]])
    live = np.flatnonzero(i < stop)
    i, j, stop = i[live], j[live], stop[live]
    probe = np.ones(len(i), np.int64)
    hit = np.zeros(len(ea), bool)
    pair = np.zeros(len(ea), np.int64)
    while len(i):
        stuck = np.zeros(len(i), bool)
        for width in np.unique(probe):
            at = np.flatnonzero(probe == width)
            x, y = i[at], j[at]
            step = np.arange(width)
            p, q = x[:, None] + step, y[:, None] + step
            same = (p < stop[at][:, None]) & (q < len(eb))
            same &= ea[np.minimum(p, len(ea) - 1)] == eb[np.minimum(q, len(eb) - 1)]
            run = np.where(same.all(axis=1), width, same.argmin(axis=1))
            inside = step < run[:, None]
            hit[p[inside]] = True
            pair[p[inside]] = q[inside]
            i[at] += run
            j[at] += run
            stuck[at] = run < width
            probe[at] = np.where(run < width, 1, np.minimum(2 * width, lane))
        # an irregular group ends where both sides meet again; the shift is new there
        at = np.flatnonzero(stuck & (i < stop))
        if len(at):
            x, y = _meet(ea, eb, i[at], j[at])
            hit[x] = True
            pair[x] = y
            i[at], j[at] = x + 1, y + 1
        live = i < stop
        i, j, stop, probe = i[live], j[live], stop[live], probe[live]
    ia = np.flatnonzero(hit)
    return ia, pair[ia]


class Aligner:
    """Both tokenizers and what is looked up of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteBpe(a_path), Pieces(b_path)
        self.len_a = np.array([len(x) for x in self.a.bytes], np.int64)
        self.len_b = np.array([len(x) for x in self.b.bytes], np.int64)
        na, nb = len(self.a.bytes), len(self.b.bytes)
        # how a token is written inside its side of a group, and at its end
        self.written = pa.array([f"{i}," for i in range(na)] + [f"{i}|" for i in range(na)]
                                + [f"{i}," for i in range(nb)] + [f"{i};" for i in range(nb)], pa.large_string())
        self.na, self.nb = na, nb

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Both sides' ids; none if a side does not give the text back."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not text:
            return none
        raw = (" " + text).encode("utf-8", "surrogatepass")
        a, b = self.a.encode(" " + text), self.b.encode(text)
        if self.len_a[a].sum() != len(raw) or self.len_b[b].sum() != len(raw):
            return none
        if b"".join(map(self.a.bytes.__getitem__, a.tolist())) != raw:
            return none
        if b"".join(map(self.b.bytes.__getitem__, b.tolist())) != raw:
            return none
        return a, b

    def documents(self, texts: list[str | None]) -> dict[str, np.ndarray | list]:
        """Per text its counts, digest and links (A id * B ids + B id)."""
        sides = [self.encode(t) for t in texts]
        n_a = np.array([len(a) for a, _ in sides], np.int64)
        n_b = np.array([len(b) for _, b in sides], np.int64)
        a = np.concatenate([x for x, _ in sides]) if sides else np.zeros(0, np.int64)
        b = np.concatenate([y for _, y in sides]) if sides else np.zeros(0, np.int64)
        ia, ib = common_ends(np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b]))
        end_a, end_b = np.cumsum(n_a), np.cumsum(n_b)
        cut = np.searchsorted(ia, end_a)  # links before each document's end
        n_groups = np.diff(cut, prepend=0)
        # the groups, written out: A tokens of a group, then its B tokens
        last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        last_a[ia], last_b[ib] = True, True
        group_a = np.cumsum(last_a) - last_a
        group_b = np.cumsum(last_b) - last_b
        before = np.concatenate([[0], ib + 1])  # B tokens in earlier groups
        through = np.concatenate([ia + 1, [len(a)]])  # A tokens up to the group's end
        line = np.empty(len(a) + len(b), np.int64)
        line[np.arange(len(a)) + before[group_a]] = a + self.na * last_a
        line[np.arange(len(b)) + through[group_b]] = 2 * self.na + b + self.nb * last_b
        text = self.written.take(pa.array(line))
        offsets = np.frombuffer(text.buffers()[1], np.int64)[:len(line) + 1] if len(line) else np.zeros(1, np.int64)
        data = memoryview(text.buffers()[2]) if len(line) else memoryview(b"")
        ends = offsets[end_a + end_b].tolist()
        digests = [hashlib.sha256(data[s:e - 1]).hexdigest() if e > s else "" for s, e in zip([0, *ends[:-1]], ends)]
        return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "digest": digests,
                "links": a[ia] * self.nb + b[ib], "cut": cut}


def _slices(batch: pa.RecordBatch, size: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows of at most ``most`` together, by ``size``; a larger row is alone."""
    start = total = 0
    for i, n in enumerate(size):
        if i > start and total + n > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)


def _sizes(lengths: pa.Array) -> np.ndarray:
    return pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False).astype(np.int64)


class Counts:
    """How often each link occurred; links are gathered and counted LINKS at a time."""

    def __init__(self):
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.waiting, self.n = [], 0

    def add(self, links: np.ndarray):
        self.waiting.append(links)
        self.n += len(links)
        if self.n >= LINKS:
            self.settle()

    def settle(self):
        new, n = np.unique(np.concatenate([np.zeros(0, np.int64), *self.waiting]), return_counts=True)
        self.waiting, self.n = [], 0
        at = np.searchsorted(self.keys, new)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == new[known]
        self.counts[at[known]] += n[known]
        self.keys = np.insert(self.keys, at[~known], new[~known])
        self.counts = np.insert(self.counts, at[~known], n[~known])


def _encode(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, seen, id_type = None, Counts(), None
        names = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links", "counts"]
        for batch in batches:
            for part in _slices(batch, _sizes(pc.binary_length(batch.column("text"))), SLICE):
                aligner = aligner or Aligner(a_path, b_path)
                id_type = part.column("doc_id").type
                got = aligner.documents(part.column("text").to_pylist())
                seen.add(got["links"])
                offsets = pa.array(np.concatenate([[0], got["cut"]]).astype(np.int32))
                links = pa.ListArray.from_arrays(offsets, pa.array(got["links"]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(got["n_a"]), pa.array(got["n_b"]), pa.array(got["n_groups"]),
                     pa.array(got["digest"], pa.string()), links, pa.nulls(part.num_rows, pa.list_(pa.int64()))], names=names)
        seen.settle()
        if len(seen.keys):  # the task's pair counts: one row without a digest
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, id_type), *[pa.nulls(1, pa.int64())] * 3, pa.nulls(1, pa.string()),
                 pa.array([seen.keys], pa.list_(pa.int64())), pa.array([seen.counts], pa.list_(pa.int64()))], names=names)
    return run


def _judge(keys: np.ndarray, counts: np.ndarray, best: np.ndarray):
    def per_row(values: np.ndarray, ends: np.ndarray) -> pa.Array:
        return pa.array(np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[ends], prepend=0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, _sizes(pc.list_value_length(batch.column("links"))), LINKS):
                links = part.column("links")
                size = _sizes(links.value_lengths())
                at = np.searchsorted(keys, links.flatten().to_numpy(zero_copy_only=False))
                ends = np.cumsum(size)
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in ("doc_id", "n_a", "n_b", "n_groups")]
                    + [pa.array(size), per_row(best[at], ends), per_row(counts[at], ends), part.column("groups_sha256")],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])
    return run


def encode(docs: DataFrame, a_path: str = BYTE_BPE, b_path: str = PIECES) -> DataFrame:
    """Documents (doc_id, text) -> the written first pass: a row per document
    (doc_id, n_a, n_b, n_groups, groups_sha256, links) and a row of partial
    pair counts per task (links, counts; the digest is null)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return written(docs.select("doc_id", "text").mapInArrow(
        _encode(a_path, b_path), f"doc_id {id_type}, n_a long, n_b long, n_groups long, groups_sha256 string, "
                                 "links array<long>, counts array<long>"), "aligned", compression="zstd")


def pair_table(first: DataFrame, n_b: int) -> DataFrame:
    """The first pass's rows -> (pair, a, b, n, best): corpus-wide count of
    each linked id pair and whether it is its B id's highest."""
    part = first.where(F.col("groups_sha256").isNull()).select(F.explode(F.arrays_zip("links", "counts")).alias("x"))
    total = part.groupBy(F.col("x.links").alias("pair")).agg(F.sum("x.counts").alias("n"))
    total = written(total.select("pair", F.expr(f"pair div {n_b}").alias("a"), F.expr(f"pair % {n_b}").alias("b"), "n"),
                    "aligned-pairs")
    top = total.groupBy("b").agg(F.max("n").alias("top"))
    return total.join(top, "b").select("pair", "a", "b", "n", (F.col("n") == F.col("top")).alias("best"))


def align(docs: DataFrame, a_path: str = BYTE_BPE, b_path: str = PIECES) -> DataFrame:
    """Documents (doc_id, text) -> doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256."""
    n_b = len(Pieces(b_path).bytes)
    first = encode(docs, a_path, b_path)
    # bounded by possible_pairs of the two vocabularies, whatever the corpus
    pairs = pair_table(first, n_b).select("pair", "n", "best").toArrow().sort_by("pair")
    keys, counts, best = (pairs.column(c).to_numpy() for c in ("pair", "n", "best"))
    rows = first.where(F.col("groups_sha256").isNotNull()).drop("counts")
    held = docs.sparkSession.sparkContext.broadcast((keys, counts, best))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        lambda batches: _judge(*held.value)(batches),
        f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
