"""Personal data by weak supervision (DataFrame functions only).

Base spans are the fixed patterns for e-mail addresses, IPv4 addresses, cards
and phone numbers, with their checks.  Beyond them, candidates (key-like
strings and number groups that no base span touches) are voted on by labelers:
shape expressions, gazetteers and words of the context, each saying yes (1),
no (-1) or nothing (0).  Expectation-maximisation on the counts of vote
patterns over all documents estimates each labeler's reliability and each
pattern's probability; with these as soft labels a logistic span classifier is
trained on features of the span and its context, and candidates it gives at
least ``at`` become spans of kind ``secret`` or ``number``.

Positions are code points, end exclusive: a text split at a pattern's matches
gives the gaps between them, and running sums of gaps and matches the places.

Defined results: null and empty texts have no spans; a null doc_id stands for
itself; rows equal in id and text get equal results, one each; without
candidates there are base spans only; where all candidates' evidence lies on one
side, their own probabilities decide (a tie at ``at`` is a span); very long
texts are matched whole; an empty table gives no rows.  Other columns are never read.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import sized, written

#: Base patterns.  They find what the plain patterns find: a match can begin
#: only where the run of its first class does, or where the last match ended
#: (\G), and possessive runs spare retries, so a text takes linear time.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: candidates: key-like strings, and number groups
SECRET = r"(?:\G|(?<![A-Za-z0-9+/_-]))[A-Za-z0-9+/_-]{12,}+"
NUMBER = r"(?:\G|(?<![0-9A-Za-z]))\(?+[0-9]++(?:[\x20().-]{1,3}+[0-9]++)*+"
KINDS = ("email", "ip", "card", "phone", "secret", "number")
BASE = KINDS[:4]

#: fixed values: words around secrets, around personal numbers, around other numbers
SECRET_WORDS = r"(?i)(token|passw|secret|api|key|pwd|auth|bearer|credential)"
NUMBER_WORDS = r"(?i)(phone|tel|mobile|call|fax|account|iban|card|ssn|passport|insurance|konto|compte|cuenta)"
OTHER_WORDS = r"(?i)(version|license|licence|page|isbn|chapter|figure|table|year|copyright)"
PLACEHOLDERS = r"(?i)(example|sample|dummy|test|your|xxxx|0000|1234567|abcdef)"
#: fixed values: calling codes that a grouped number may start with
CALLING = r"^\(?(00|1|33|34|44|49|52|54)[\x20().-]"


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    rev = F.reverse(digits)

    def add(total, i):
        d = F.substring(rev, i, 1).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 0, twice - F.when(twice > 9, 9).otherwise(0)).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _passes(kind: Column, m: Column) -> Column:
    """The check of each base kind on a match."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    part = lambda x: (F.length(F.ltrim(x, F.lit("0"))) <= 3) & (
        F.coalesce(F.substring(F.ltrim(x, F.lit("0")), 1, 3).try_cast("int"), F.lit(0)) <= 255)
    return (F.when(kind == "ip", F.forall(F.split(m, r"\."), part))
            .when(kind == "card", F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False))
            .when(kind == "phone", F.length(digits).between(8, 15))
            .otherwise(True))


def find(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, h, text) -> every match (doc_id, h, kind, start,
    end, m, left, right): one pass over the texts."""
    has_digit = F.col("text").rlike("[0-9]")
    plans = {"email": (EMAIL, F.col("text").contains("@")), "ip": (IP, F.col("text").rlike(r"[0-9]\.[0-9]")),
             "card": (CARD, has_digit), "phone": (PHONE, F.col("text").contains("+")),
             "secret": (SECRET, has_digit), "number": (NUMBER, has_digit)}
    cut = docs.select("doc_id", "h", *[c for k, (p, pre) in plans.items() for c in (
        F.when(pre, F.split("text", p, -1)).alias(f"p_{k}"),
        F.when(pre, F.regexp_extract_all("text", F.lit(p), F.lit(0))).alias(f"m_{k}"))])

    def rows(k: str) -> Column:
        p = F.col(f"p_{k}")
        out = F.transform(F.col(f"m_{k}"), lambda x, i: F.struct(
            F.lit(k).alias("kind"), i.alias("i"), F.length(F.get(p, i)).alias("gap"), x.alias("m"),
            F.right(F.get(p, i), F.lit(32)).alias("left"), F.left(F.get(p, i + 1), F.lit(16)).alias("right")))
        return out
    every = F.concat(*[F.coalesce(rows(k), F.array().cast(
        "array<struct<kind:string,i:int,gap:int,m:string,left:string,right:string>>")) for k in KINDS])
    r = cut.select("doc_id", "h", F.explode(every).alias("r")).select("doc_id", "h", "r.*")
    line = Window.partitionBy("doc_id", "h", "kind").orderBy("i")
    r = r.dropDuplicates(["doc_id", "h", "kind", "i"]).withColumn(
        "end", F.sum(F.col("gap") + F.length("m")).over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return r.select("doc_id", "h", "kind", (F.col("end") - F.length("m")).alias("start"), "end", "m", "left", "right")


def _votes(kind: Column, m: Column, left: Column, right: Column) -> list[Column]:
    """The labelers."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(m)
    secret = kind == "secret"

    def vote(for_secret: Column, for_number: Column) -> Column:
        return F.coalesce(F.when(secret, for_secret).otherwise(for_number), F.lit(0)).cast("int")
    yes, no = F.lit(1), F.lit(-1)
    return [
        # shape
        vote(F.when(m.rlike("^[0-9a-fA-F]{16,}$") & m.rlike("[a-fA-F]") & m.rlike("[0-9]"), yes)
             .when(m.rlike(r"[a-z]{6}") & ~m.rlike("[0-9]{2}"), no),
             F.when(m.rlike(r"^\(?[0-9]{1,4}\)?([\x20.-][(]?[0-9]{2,4}[)]?){2,}$"), yes).when(F.length(digits) < 7, no)),
        # words of the context
        vote(F.when(left.rlike(SECRET_WORDS), yes), F.when(left.rlike(NUMBER_WORDS), yes).when(left.rlike(OTHER_WORDS), no)),
        # gazetteers
        vote(F.when(m.rlike(PLACEHOLDERS), no), F.when(m.rlike(PLACEHOLDERS), no).when(m.rlike(CALLING), yes)),
        # how it is set
        vote(F.when(left.rlike(r"[=:]\s*[\"']?$"), yes).otherwise(no),
             F.when(left.rlike(r"[:#]\s*$"), yes).otherwise(no)),
        # content
        vote(F.when((F.length(digits) >= n * 0.2) & (F.length(digits) < n), yes).otherwise(no),
             F.when(F.length(digits).between(13, 19), F.when(luhn(digits), yes).otherwise(no))),
    ]


def _features(kind: Column, m: Column, left: Column, right: Column) -> dict[str, Column]:
    """What the final classifier sees of a span."""
    digits = F.length(F.regexp_replace(m, "[^0-9]", ""))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    return {"x_secret": flag(kind == "secret"), "x_length": F.least(F.length(m), F.lit(64)) / F.lit(64.0),
            "x_digits": digits / F.length(m), "x_hex": flag(m.rlike("^[0-9a-fA-F]+$")),
            "x_upper": flag(m.rlike("[A-Z]")), "x_word": flag(m.rlike("[a-z]{6}")),
            "x_set": flag(left.rlike(r"[=:]\s*[\"']?$")), "x_quoted": flag(left.rlike("[\"']$") & right.rlike("^[\"']")),
            "x_secret_word": flag(left.rlike(SECRET_WORDS)), "x_number_word": flag(left.rlike(NUMBER_WORDS)),
            "x_other_word": flag(left.rlike(OTHER_WORDS)), "x_grouped": flag(m.rlike(r"[0-9][\x20().-]+[0-9]")),
            "x_long_number": flag((digits >= 7) & (digits <= 15))}


def em(counts: list[tuple[tuple[int, ...], float]], rounds: int = 50) -> tuple[list[float], list[dict]]:
    """Vote patterns with their counts -> the probability of each pattern and
    each labeler's P(vote | yes), P(vote | no).

    Labelers are taken as independent given the truth; the start is the share
    of yes among a pattern's votes.  Patterns are at most 3 ** labelers,
    whatever the size of the corpus.
    """
    if not counts:
        return [], []
    width = len(counts[0][0])
    p = [(1 + sum(v > 0 for v in votes)) / (2 + sum(v != 0 for v in votes)) for votes, _ in counts]
    p = [x * x / (x * x + (1 - x) * (1 - x)) for x in p]
    table: list[dict] = []
    for _ in range(rounds):
        yes = sum(c * x for (_, c), x in zip(counts, p))
        no = sum(c * (1 - x) for (_, c), x in zip(counts, p))
        table = []
        for i in range(width):
            t = {}
            for v in (-1, 0, 1):
                a = sum(c * x for (votes, c), x in zip(counts, p) if votes[i] == v)
                b = sum(c * (1 - x) for (votes, c), x in zip(counts, p) if votes[i] == v)
                t[v] = ((a + 0.5) / (yes + 1.5), (b + 0.5) / (no + 1.5))
            table.append(t)
        prior = math.log((yes + 1) / (no + 1))
        score = [prior + sum(math.log(table[i][v][0] / table[i][v][1]) for i, v in enumerate(votes) if v)
                 for votes, _ in counts]
        p = [1 / (1 + math.exp(-max(-30.0, min(30.0, s)))) for s in score]
    return p, table


def classify(candidates: DataFrame, at: float = 0.5) -> DataFrame | None:
    """Candidates (.., kind, m, left, right) -> those the span classifier
    accepts, with ``p``; None without candidates.  Where all soft labels lie on
    one side a classifier has nothing to tell apart, and each candidate's
    own EM probability decides."""
    spark = candidates.sparkSession
    cols = F.col("kind"), F.col("m"), F.col("left"), F.col("right")
    feats = _features(*cols)
    c = written(candidates.withColumn("votes", F.array(*_votes(*cols))).withColumns(feats), "pii-candidates")
    soft = []
    for kind in ("secret", "number"):
        seen = c.where(F.col("kind") == kind).groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()
        seen = sorted((tuple(r["votes"]), float(r["n"])) for r in seen)
        soft += [(kind, v, x) for (v, _), x in zip(seen, em(seen)[0])]
    if not soft:
        return None
    told = spark.sql("SELECT * FROM VALUES " + ", ".join(
        f"('{k}', array({', '.join(map(str, v))}), {x!r}D)" for k, v, x in soft) + " AS t(kind, votes, truth)")
    if max(x for *_, x in soft) < at or min(x for *_, x in soft) >= at:
        return (c.join(told, ["kind", "votes"]).where(F.col("truth") >= at)
                .select("doc_id", "h", "kind", "start", "end", F.col("truth").alias("p")))
    names = list(feats)
    # equal spans are one weighted row: the fit reads a table of feature patterns, not of spans
    rows = (c.groupBy("kind", "votes", *names).agg(F.count(F.lit(1)).alias("n")).join(told, ["kind", "votes"])
            .select(*names, F.explode(F.array(
                F.struct(F.lit(1.0).alias("label"), (F.col("n") * F.col("truth")).alias("weight")),
                F.struct(F.lit(0.0).alias("label"), (F.col("n") * (1 - F.col("truth"))).alias("weight")))).alias("t"))
            .select(*names, "t.label", "t.weight"))
    vec = VectorAssembler(inputCols=names, outputCol="features")
    model = LogisticRegression(weightCol="weight", regParam=1e-3, maxIter=50).fit(written(vec.transform(rows), "pii-fit"))
    out = model.transform(vec.transform(c)).withColumn("p", vector_to_array("probability")[1])
    return out.where(F.col("p") >= at).select("doc_id", "h", "kind", "start", "end", "p")


def spans(docs: DataFrame, at: float = 0.5) -> DataFrame:
    """Documents (doc_id, text) -> all spans (doc_id, h, kind, start, end);
    ``h`` is the text's hash."""
    d = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), F.coalesce("text", F.lit("")).alias("text"))
    found = written(find(d), "pii-matches")
    base = found.where(F.col("kind").isin(*BASE) & _passes(F.col("kind"), F.col("m")))
    # a candidate has a digit and, if key-like, a letter; numbers have seven digits
    digits = F.regexp_replace("m", "[^0-9]", "")
    cand = found.where(F.when(F.col("kind") == "secret", F.col("m").rlike("[A-Za-z]") & (digits != ""))
                       .when(F.col("kind") == "number", F.length(digits) >= 7).otherwise(False))
    # spans of a document in order of place: a candidate that a base span touches goes
    both = (base.select("doc_id", "h", "kind", "start", "end", "m", "left", "right", F.lit(True).alias("base"))
            .unionByName(cand.withColumn("base", F.lit(False))))
    line = Window.partitionBy("doc_id", "h").orderBy("start", "end", "kind")
    before = F.max(F.when(F.col("base"), F.col("end"))).over(line.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(F.col("base"), F.col("start"))).over(line.rowsBetween(1, Window.unboundedFollowing))
    free = both.withColumn("b", before).withColumn("a", after).where(
        ~F.col("base") & (F.coalesce("b", F.lit(0)) <= F.col("start")) & (F.col("a").isNull() | (F.col("a") >= F.col("end"))))
    # of overlapping candidates the key-like one stays
    prior = F.max(F.when(F.col("kind") == "secret", F.col("end"))).over(line.rowsBetween(Window.unboundedPreceding, -1))
    later = F.min(F.when(F.col("kind") == "secret", F.col("start"))).over(line.rowsBetween(1, Window.unboundedFollowing))
    free = free.withColumn("b", prior).withColumn("a", later).where(
        (F.col("kind") == "secret") | ((F.coalesce("b", F.lit(0)) <= F.col("start"))
                                       & (F.col("a").isNull() | (F.col("a") >= F.col("end")))))
    more = classify(free.select("doc_id", "h", "kind", "start", "end", "m", "left", "right"), at)
    out = base.select("doc_id", "h", "kind", "start", "end")
    return out if more is None else out.unionByName(more.drop("p"))


def by_document(found: DataFrame) -> DataFrame:
    """Spans -> (_pii_id, _pii_h, _pii_spans): each document's spans in the
    order of kinds."""
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    return found.groupBy(F.col("doc_id").alias("_pii_id"), F.col("h").alias("_pii_h")).agg(
        F.array_sort(F.collect_list(F.struct(rank.alias("k"), "start", "end", "kind"))).alias("_pii_spans"))


def _attached(docs: DataFrame, at: float) -> DataFrame:
    """``docs`` (with columns doc_id, text, any others) plus ``_pii_spans``."""
    per = written(by_document(spans(docs, at)), "pii-spans")
    keyed = docs.withColumn("_pii_text", F.xxhash64(F.coalesce("text", F.lit(""))))
    return (keyed.join(sized(per, "_pii_spans", 64),
                       F.col("doc_id").eqNullSafe(F.col("_pii_id")) & (F.col("_pii_text") == F.col("_pii_h")), "left")
            .drop("_pii_id", "_pii_h", "_pii_text"))


def report(docs: DataFrame, at: float = 0.5) -> DataFrame:
    """Documents (doc_id, text) -> doc_id and ``spans`` (k, start, end, kind)."""
    out = _attached(docs.select("doc_id", "text"), at).drop("text")
    empty = F.array().cast("array<struct<k:int,start:bigint,end:bigint,kind:string>>")
    return out.select("doc_id", F.coalesce("_pii_spans", empty).alias("spans"))


def redact(docs: DataFrame, at: float = 0.5) -> DataFrame:
    """``docs`` with each span of ``text`` replaced by its kind in angle
    brackets; overlapping spans (an address inside a longer number, say) are
    replaced as one, named after the first.  Columns stay as they are."""
    names = docs.columns
    found = _attached(docs, at)
    s = F.array_sort(F.transform("_pii_spans", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
    merged = F.aggregate(s, F.slice(s, 1, 0), lambda acc, x: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] > x["start"]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
            F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end"),
            F.element_at(acc, -1)["kind"].alias("kind"))))).otherwise(F.concat(acc, F.array(x))))
    found = found.withColumn("_pii_cut", merged)
    text = F.col("text")
    parts = F.transform("_pii_cut", lambda x, i: F.concat(
        F.substring(text, (F.when(i == 0, F.lit(1)).otherwise(F.get(F.col("_pii_cut"), i - 1)["end"] + 1)).cast("int"),
                    (x["start"] - F.when(i == 0, F.lit(0)).otherwise(F.get(F.col("_pii_cut"), i - 1)["end"])).cast("int")),
        F.lit("<"), F.upper(x["kind"]), F.lit(">")))
    tail = F.substring(text, (F.element_at("_pii_cut", -1)["end"] + 1).cast("int"), F.length(text))
    clean = F.when(F.size("_pii_cut") > 0, F.concat(F.array_join(parts, ""), tail)).otherwise(text)
    return found.withColumn("text", clean).select(*names)
