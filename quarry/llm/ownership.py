"""Secrets, told from examples by who holds them.

Base spans are the fixed patterns for assigned passwords and tokens, access
keys and long hexadecimal strings.  Beyond them, key-like strings that no base
span touches are candidates of kind ``key``: at least ``KEY_CHARS`` characters
letters of both cases, three digits, no long run of small letters or digits,
and at least ``ENTROPY`` bits a character.

Every secret's value goes by its hash.  Over the whole corpus each hash is
counted by the distinct repositories and the distinct owners that hold it: a
value of many owners has been copied from documentation (an example), a value
of at most ``max_owners`` looks live.  Live candidates become spans of kind
``key``; base spans stay whatever the verdict, which is given with each span.

A repository is by default a text (copies of one file count once), an owner
its source.  The hashes, not the values, leave the scan.

Scale: one pass over the texts; occurrences (hash, owner, repository) are
aggregated by hash, and the verdict goes back to the occurrences in a join
that splits hashes with very many of them (``spread_join``).

Defined results: null and empty texts have no spans; a null owner counts as one
owner of its own; rows that repeat an id or a text get a row each; very long
texts are scanned whole, in linear time; spans that start together come in the
order of kinds; an empty table gives no rows.  Other columns are never read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import spread_join, written

KINDS = ("assign", "access", "hex", "key")
BASE = KINDS[:3]
#: fixed patterns; of a match, the named group or the whole is the value
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?(?P<v>[A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KEY_CHARS = 20
KEY = re.compile(r"[A-Za-z0-9+/_-]{%d,}" % KEY_CHARS)
ENTROPY = 3.3
#: words without which ASSIGN cannot match
_NAMES = ("passw", "secret", "token", "api")

_SPAN = pa.struct([("start", pa.int64()), ("k", pa.int32()), ("end", pa.int64()), ("value", pa.string())])
_FOUND = "rid long, doc_id {id}, owner string, repo string, spans array<struct<start:long,k:int,end:long,value:string>>"


def entropy(s: str) -> float:
    """Shannon entropy of a string's characters, in bits a character."""
    return -sum(c / len(s) * math.log2(c / len(s)) for c in Counter(s).values())


def key_like(s: str) -> bool:
    """Whether a string looks like a random key, not like words or a path."""
    return (sum(c.isdigit() for c in s) >= 3 and any(c.isupper() for c in s) and any(c.islower() for c in s)
            and not re.search("[a-z]{7}|[0-9]{9}|//", s) and entropy(s) >= ENTROPY)


def scan_text(text: str) -> list[tuple[int, int, int, str]]:
    """The base spans and candidates of one text: (start, end, kind, value)."""
    out = []
    low = text.lower()
    if any(n in low for n in _NAMES):
        out += [(m.start(), m.end(), 0, m["v"]) for m in ASSIGN.finditer(text) if len(m["v"]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), 1, m[0]) for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), 2, m[0]) for m in HEX.finditer(text)]
    out.sort()
    base = list(out)
    i = reach = 0
    for m in KEY.finditer(text):
        # base spans that begin before the candidate ends, and how far they reach
        while i < len(base) and base[i][0] < m.end():
            reach = max(reach, base[i][1])
            i += 1
        if reach <= m.start() and key_like(m[0]):
            out.append((m.start(), m.end(), 3, m[0]))
    out.sort()
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = []
        for text in batch.column("text"):
            spans.append([{"start": s, "k": k, "end": e, "value": hashlib.md5(v.encode("utf-8", "surrogatepass")).hexdigest()}
                          for s, e, k, v in scan_text(text.as_py())])
        names = ["rid", "doc_id", "owner", "repo"]
        yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(spans, pa.list_(_SPAN))],
                                         names=[*names, "spans"])


def census(held: DataFrame) -> DataFrame:
    """Occurrences (value, owner, repo) -> value, n_repos, n_owners.  Both
    counts are of distinct ones and partly aggregated before the shuffle, so a
    value held by a third of the corpus is no hot key."""
    return held.groupBy("value").agg(F.count_distinct("repo").alias("n_repos"), F.count_distinct("owner").alias("n_owners"))


def scan(docs: DataFrame, owner: Column | None = None, repo: Column | None = None, max_owners: int = 1) -> DataFrame:
    """Documents (doc_id, text, ..) -> doc_id and ``spans`` (start, k, end,
    kind, value, n_repos, n_owners, live), candidates of many owners included.

    ``owner`` and ``repo`` are columns of ``docs``; the default owner is the
    column ``source``, the default repository the text.
    """
    owner = F.col("source") if owner is None else owner
    repo = F.xxhash64("text") if repo is None else repo
    # a row number given at the time of writing keeps rows apart that share an id
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id",
                       F.coalesce(owner.cast("string"), F.lit("\u0000")).alias("owner"),
                       F.coalesce(repo.cast("string"), F.lit("")).alias("repo"),
                       F.coalesce("text", F.lit("")).alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = written(rows.mapInArrow(_scan, _FOUND.format(id=id_type)), "secret-spans")
    held = written(found.select("rid", "owner", "repo", F.explode("spans").alias("s")).select("rid", "owner", "repo", "s.*"),
                   "secret-holders")
    judged = spread_join(held.drop("owner", "repo"), written(census(held), "secret-census"), "value")
    judged = judged.withColumn("live", F.col("n_owners") <= max_owners)
    kind = F.element_at(F.array(*map(F.lit, KINDS)), F.col("k") + 1).alias("kind")
    per = judged.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct(
        "start", "k", "end", kind, "value", "n_repos", "n_owners", "live"))).alias("spans"))
    none = F.array().cast(per.schema["spans"].dataType)
    return found.select("rid", "doc_id").join(per, "rid", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))
