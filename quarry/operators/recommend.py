"""Implicit-feedback recommendation: alias resolution, popularity scorer,
per-user AUC with sampled negatives, k-fold cross-validation, ALS.

Scorers are plain functions ``(train, pairs) -> pairs + score`` so any model
(popularity, ALS, ...) plugs into the same AUC evaluator.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.expr import hash_int
from quarry.operators import ordered

Scorer = Callable[[DataFrame, DataFrame], DataFrame]


def parse_id_name(lines: DataFrame) -> DataFrame:
    """'id<TAB>name' lines -> (id, name); ids that are not integers, and lines
    without a tab, are dropped; names are trimmed."""
    p = F.split(F.col("value"), "\t", 2)
    return (lines.select(p[0].try_cast("long").alias("id"),
                         F.trim(F.get(p, 1)).alias("name"))
            .where(F.col("id").isNotNull() & F.col("name").isNotNull()))


def parse_alias(lines: DataFrame) -> DataFrame:
    """'bad<TAB>good' lines -> (bad, good); blank or non-integer rows dropped;
    of lines with one bad id the last wins, as in a map filled line by line."""
    p = F.split(F.col("value"), "\t")
    return (lines.select(p[0].try_cast("long").alias("bad"), F.get(p, 1).try_cast("long").alias("good"),
                         F.monotonically_increasing_id().alias("line"))
            .where(F.col("bad").isNotNull() & F.col("good").isNotNull())
            .groupBy("bad").agg(F.max_by("good", "line").alias("good")))


def resolve_alias(ratings: DataFrame, alias: DataFrame) -> DataFrame:
    """Map item ids through the alias table (default: itself) and sum the
    counts that become duplicates of one (user, item).  A bad id listed twice
    (with no order to tell the last) maps to the larger good id, so no play is
    counted twice.  The join is left to AQE's runtime size check."""
    a = alias.groupBy(F.col("bad").alias("item")).agg(F.max("good").alias("good"))
    r = ratings.join(a, "item", "left").withColumn("item", F.coalesce("good", "item"))
    return r.groupBy("user", "item").agg(F.sum("count").alias("count"))


def popularity_scorer(train: DataFrame, pairs: DataFrame) -> DataFrame:
    """Score = total count of the item in ``train`` (0.0 if unseen)."""
    pop = train.groupBy("item").agg(F.sum("count").cast("double").alias("pop"))
    return pairs.join(pop, "item", "left").withColumn("score", F.coalesce("pop", F.lit(0.0))).drop("pop")


def item_index(items: DataFrame) -> DataFrame:
    """Dense 0-based index of each distinct item in item order, JVM-side.

    Range-partition and sort the distinct items, tag rows with
    ``monotonically_increasing_id`` (partition id in the upper bits, row
    position below), write once so the tags are fixed, then add each
    partition's offset = rows in all earlier partitions (a table with one row
    per partition, broadcast)."""
    from quarry.session import shared_dir
    shared_dir(items.sparkSession)
    d = (items.select("item").distinct().repartitionByRange("item").sortWithinPartitions("item")
         .withColumn("_mid", F.monotonically_increasing_id()).checkpoint())
    pid = F.shiftright(F.col("_mid"), 33)
    counts = d.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a global window over a partition-count-sized table
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    off = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    local = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    return (d.join(F.broadcast(off), pid == F.col("_pid"))
            .select("item", (F.col("_off") + local).cast("long").alias("idx")))


DRAW_CHUNK = 4096
#: positives of a group whose first draws are made and judged inside one row
ROW_POSITIVES = 128


def _draws_in_rows(pos: DataFrame, idx: DataFrame, n_items, seed: int, g: list[str]) -> DataFrame:
    """(group, n_pos, idxs): the first draws of each group of at most
    ROW_POSITIVES positives that are not positives, as item numbers, at most
    n_pos of them; fewer when the draws did not do."""
    per = (pos.join(idx, "item", "left").groupBy(*g).agg(F.count(F.lit(1)).alias("n_pos"), F.collect_list("idx").alias("own")))
    end = F.least(F.col("n_pos") * 2 + 8, F.col("n"))
    number = lambda j: F.pmod(hash_int(*[F.col(c) for c in g], j, F.lit(seed)), F.col("n"))
    places = F.when(end > 0, F.sequence(F.lit(0).cast("long"), end - 1)).otherwise(F.array().cast("array<bigint>"))
    drawn = F.transform(places, number)
    return (per.withColumn("n", n_items).select(*g, "n_pos", "own", drawn.alias("drawn"))
            .select(*g, "n_pos", F.slice(F.filter("drawn", lambda i: ~F.array_contains("own", i)), 1, F.col("n_pos").cast("int"))
                    .alias("idxs")))


def sample_negatives(positives: DataFrame, items: DataFrame, seed: int = 42,
                     group: tuple[str, ...] = ("user",)) -> DataFrame:
    """Per group (user), as many negatives as distinct positives.

    Draw j of a user is item number hash(user, j, seed) mod n_items; the
    negatives are the first n_pos draws (in j order) that are not positives,
    duplicates allowed, at most n_items draws.  Draws are generated in rounds
    of growing size until every user is satisfied or has used all n_items
    draws (no round cap), so the result is exact without generating
    users x items.  Groups of few positives make their first draws inside a row;
    only those that these leave short, and groups of many positives, take the rounds.
    """
    from quarry.session import last_use, shared_dir
    shared_dir(positives.sparkSession)
    idx = item_index(items).checkpoint()
    n_items = idx.select(F.count(F.lit(1))).scalar()
    g = list(group)
    pos = positives.select(*g, "item").distinct()
    every = pos.groupBy(*g).agg(F.count(F.lit(1)).alias("n_pos")).where(F.expr(" and ".join(f"{c} is not null" for c in g)))
    many = last_use(every.where(F.col("n_pos") > ROW_POSITIVES), lambda x: x.checkpoint())
    some = pos.join(many.select(*g), g, "left_anti") if many.limit(1).count() else pos
    made = last_use(_draws_in_rows(some, idx, n_items, seed, g), lambda x: x.checkpoint())
    full = F.size("idxs") == F.col("n_pos")
    result = made.where(full).select(*g, F.explode("idxs").alias("idx")).join(idx, "idx").select(*g, "item", F.lit(0).alias("j"))
    todo = (made.where(~full).select(*g, "n_pos").unionByName(many)
            .select(*g, "n_pos", F.lit(0).cast("long").alias("have"),
                    F.lit(0).cast("long").alias("next_j"))).checkpoint()
    if todo.limit(1).count() == 0:
        return result.select(*g, "item")
    pos = pos.join(todo.select(*g), g, "left_semi")
    rnd = 0
    while True:
        # every round advances each open user's draw index (to at most
        # n_items), so the loop ends; the slack doubles per round, so a user
        # whose positives cover most items needs only logarithmically many
        slack = F.lit(8 << min(rnd, 40)).cast("long")
        end = F.least(F.col("next_j") + (F.col("n_pos") - F.col("have")) * 2 + slack, n_items)
        rnd += 1
        # two-level generation: chunk starts first (one row per DRAW_CHUNK
        # draws), spread over tasks, then each chunk's draws - a user with a
        # huge positive set never expands all its draws inside one task
        chunks = (todo.select(*g, "n_pos", "have", end.alias("end"),
                              F.explode(F.sequence(F.col("next_j"), end - 1, F.lit(DRAW_CHUNK).cast("long")))
                              .alias("c0"))
                  .repartition(*g, "c0"))
        draws = chunks.select(*g, "n_pos", "have", "end", F.explode(
            F.sequence(F.col("c0"), F.least(F.col("c0") + DRAW_CHUNK - 1, F.col("end") - 1))).alias("j"))
        draws = draws.withColumn(
            "idx", F.pmod(hash_int(*[F.col(c) for c in g], F.col("j"), F.lit(seed)), n_items))
        cand = draws.join(idx, "idx").join(pos, g + ["item"], "left_anti")
        # rank of each candidate among the user's round (draw order j), as a
        # running count split by (user, j // 4096) so a hot user is not one task
        cand = ordered.running_sum(cand.withColumn("_k", F.struct(*g)).withColumn("_one", F.lit(1)),
                                   "_k", ["j"], "_one", F.floor(F.col("j") / 4096), "_r")
        cand = cand.withColumn("r", F.col("_r") + F.col("have")).drop("_k", "_one", "_r")
        # read twice: written once
        cand = last_use(cand.select(*g, "n_pos", "item", "j", "r"), lambda x: x.checkpoint())
        result = result.unionByName(cand.where(F.col("r") <= F.col("n_pos")).select(*g, "item", "j"))
        cnt = cand.groupBy(*g).agg(F.count(F.lit(1)).alias("c"))
        todo = (todo.join(cnt, g, "left")
                .select(*g, "n_pos", (F.col("have") + F.coalesce("c", F.lit(0))).alias("have"),
                        end.alias("next_j"))
                .where((F.col("have") < F.col("n_pos")) & (F.col("next_j") < n_items))
                .checkpoint())
        if todo.limit(1).count() == 0:
            break
    return result.select(*g, "item")


def auc_per_user(pos_scored: DataFrame, neg_scored: DataFrame,
                 group: tuple[str, ...] = ("user",)) -> DataFrame:
    """Fraction of (positive, negative) pairs with score_pos > score_neg
    (ties count 0), per user, from ranks instead of pairs: each positive
    scores the number of negatives strictly below it.  Users without
    negatives are dropped.
    """
    from quarry.session import last_use, shared_dir
    g = list(group)
    shared_dir(pos_scored.sparkSession)
    lab = (pos_scored.select(*g, "score", F.lit(1).alias("is_pos"))
           .unionByName(neg_scored.select(*g, "score", F.lit(0).alias("is_pos"))))
    lab = last_use(lab, lambda x: x.checkpoint())
    # groups are counted in buckets; in a bucket of few rows every group fits a row
    bucket = F.pmod(F.xxhash64(*[F.col(c) for c in g]), F.lit(COUNT_BUCKETS)).alias("_b")
    hot = lab.groupBy(bucket).agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > ROW_SCORES).select("_b").checkpoint()
    if hot.limit(1).count() == 0:
        return _auc_in_rows(lab, g)
    dealt = lab.select(*g, "score", "is_pos", bucket)
    return (_auc_in_rows(dealt.join(F.broadcast(hot), "_b", "left_anti").drop("_b"), g)
            .unionByName(_auc_by_windows(dealt.join(F.broadcast(hot), "_b", "left_semi").drop("_b"), g)))


#: rows of a bucket of groups up to which their scores are ranked inside a row each
ROW_SCORES = 100_000
#: buckets that groups are counted in
COUNT_BUCKETS = 200_000


def _auc_in_rows(lab: DataFrame, g: list[str]) -> DataFrame:
    """A group's scores in order, positives before negatives of one score: each
    positive counts the negatives passed so far."""
    zero = F.lit(0).cast("long")
    seen = F.aggregate(
        F.sort_array("s"), F.struct(zero.alias("n"), zero.alias("correct")),
        lambda a, x: F.struct((a["n"] + x["neg"]).alias("n"), (a["correct"] + (1 - x["neg"]) * a["n"]).alias("correct")))
    # 0.0 and -0.0 are one score
    one = F.struct((F.col("score") + F.lit(0.0)).alias("score"), (1 - F.col("is_pos")).cast("long").alias("neg"))
    per = lab.groupBy(*g).agg(F.collect_list(one).alias("s"), F.sum("is_pos").alias("np"),
                              F.sum(1 - F.col("is_pos")).alias("nn"))
    return (per.where((F.col("nn") > 0) & (F.col("np") > 0))
            .select(*g, (seen["correct"] / (F.col("np") * F.col("nn"))).alias("auc")))


def _auc_by_windows(lab: DataFrame, g: list[str]) -> DataFrame:
    per = lab.groupBy(*g, "score").agg(F.sum("is_pos").alias("p"),
                                       F.sum(1 - F.col("is_pos")).alias("n"))
    # Negatives strictly below each score: an inclusive running sum minus the
    # row itself, ordered per user but split by a coarse score bucket (signed
    # log scale, non-decreasing in the score) so a hot user is not one task.
    s = F.col("score")
    bucket = (F.signum(s) * F.floor(F.log2(F.lit(1.0) + F.abs(s)) * 8)).cast("long")
    per = per.withColumn("_k", F.struct(*g))
    per = ordered.running_sum(per, "_k", ["score"], "n", bucket, "_cum")
    per = per.withColumn("n_below", F.col("_cum") - F.col("n")).drop("_k", "_cum")
    return (per.groupBy(*g).agg(F.sum(F.col("p") * F.col("n_below")).alias("correct"),
                                F.sum("p").alias("np"), F.sum("n").alias("nn"))
            .where((F.col("nn") > 0) & (F.col("np") > 0))
            .select(*g, (F.col("correct") / (F.col("np") * F.col("nn"))).alias("auc")))


def area_under_curve(train: DataFrame, cv: DataFrame, items: DataFrame, scorer: Scorer,
                     seed: int = 42, group: tuple[str, ...] = ("user",),
                     negatives: DataFrame | None = None) -> DataFrame:
    """Per-user AUC of any scorer (a function (train, pairs) -> pairs + score):
    held-out positives from ``cv`` against as many sampled negatives from
    ``items`` (or the given ``negatives``, to score several models on one
    sample); users without negatives drop.  Mean it for the model's AUC."""
    neg = negatives if negatives is not None else sample_negatives(cv, items, seed=seed, group=group)
    ps = scorer(train, cv.select(*group, "item"))
    ns = scorer(train, neg)
    return auc_per_user(ps, ns, group)


def factor_scorer(users: DataFrame, items: DataFrame, rank: int) -> Scorer:
    """Scorer from the factors (model, id, f) of each fold's users and items
    (the product of the two; unknown users/items score 0)."""
    def dot(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            u, i = (batch.column(c).flatten().to_numpy().reshape(-1, rank).astype(float) for c in ("uf", "if"))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("fold", "user", "item", "is_pos")),
                                              pa.array(np.einsum("nr,nr->n", u, i))],
                                             names=["fold", "user", "item", "is_pos", "score"])

    def side(factors, name, f):
        return factors.select(F.col("model").alias("fold"), F.col("id").alias(name), F.col("f").alias(f))
    none = F.array_repeat(F.lit(0.0).cast("float"), rank)

    def score(_train: DataFrame, pairs: DataFrame) -> DataFrame:
        met = (pairs.join(side(items, "item", "if"), ["fold", "item"], "left")
               .join(side(users, "user", "uf"), ["fold", "user"], "left"))
        return (met.select("fold", "user", "item", "is_pos", F.coalesce("uf", none).alias("uf"), F.coalesce("if", none).alias("if"))
                .mapInArrow(dot, "fold int, user int, item int, is_pos int, score double"))
    return score


def dense_ids(ratings: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Ratings with users and items numbered from 0 as ints, which ALS needs
    (ids beyond 31 bits, or not numbers, included), and both dictionaries
    (user, uid) and (item, iid)."""
    users = (item_index(ratings.select(F.col("user").alias("item")))
             .select(F.col("item").alias("user"), F.col("idx").cast("int").alias("uid"))).checkpoint()
    items = item_index(ratings.select("item")).select("item", F.col("idx").cast("int").alias("iid")).checkpoint()
    out = ratings.join(users, "user").join(items, "item").drop("user", "item")
    return out.withColumnsRenamed({"uid": "user", "iid": "item"}), users, items


def grid_auc(ratings: DataFrame, grid: list, fit: Callable[[DataFrame, tuple], Scorer], folds: int,
             seed: int = 42, parallelism: int = 8) -> list[float | None]:
    """``folds_auc`` of models that are fitted fold by fold: in each fold
    ``fit(train, setting)`` gives a scorer of the fold's plays."""
    def fitter(train, models):
        cuts = [(f, train.where(F.col("model") == f).drop("model")) for f in models]

        def each(setting):
            def score(_train: DataFrame, pairs: DataFrame) -> DataFrame:
                return reduce(DataFrame.unionByName, [
                    fit(t, setting)(t, pairs.where(F.col("fold") == f)).select("fold", "user", "is_pos", "score") for f, t in cuts])
            return score
        return each
    return folds_auc(ratings, grid, fitter, folds, seed, parallelism)


def folds_auc(ratings: DataFrame, grid: list, fitter: Callable[[DataFrame, list[int]], Callable[[tuple], Scorer]], folds: int,
              seed: int = 42, parallelism: int = 8) -> list[float | None]:
    """The mean AUC of each setting over all folds.  ``ratings`` (user, item,
    count, fold: written, as every model reads it) is cut once and the
    negatives of all folds are drawn together.  ``fitter`` gets the plays
    outside each fold (the fold as model) and the folds, and returns
    ``fit(setting)``, which fits every fold's model and gives their scorer;
    what it makes of the folds' positives and negatives is written; one plan
    then computes the AUC of every (setting, fold, user).  A fold without
    plays, inside or outside, has no AUC and does not count."""
    from concurrent.futures import ThreadPoolExecutor

    from quarry.session import shared_dir, shuffles_removed
    spark = ratings.sparkSession
    fold = F.col("fold")
    inside = [r["fold"] for r in ratings.where(fold.between(0, folds - 1)).select("fold").distinct().collect()]  # one a fold
    models = [f for f in sorted(inside) if len(inside) > 1 or ratings.where(fold != f).limit(1).count()]
    if not models or not grid:
        return [None] * len(grid)
    neg = sample_negatives(ratings, ratings.select("item"), seed=seed, group=("fold", "user"))
    root = shared_dir(spark, "grid-scores")
    with shuffles_removed(spark):
        pairs = (ratings.select("fold", "user", "item", F.lit(1).alias("is_pos"))
                 .unionByName(neg.select("fold", "user", "item", F.lit(0).alias("is_pos")))
                 .where(fold.isin(models)).checkpoint())
        model = F.explode(F.array(*[F.lit(f) for f in models])).alias("model")
        train = ratings.select("user", "item", "count", "fold", model).where(F.col("model") != fold).drop("fold")
        fit = fitter(train, models)

        def one(i):
            scored = fit(grid[i])(train, pairs)
            scored.select(F.lit(i).alias("setting"), "fold", "user", F.col("score").cast("double").alias("score"), "is_pos") \
                .write.parquet(f"{root}/setting-{i}")
        with ThreadPoolExecutor(max_workers=parallelism) as ex:   # concurrent fits, like ML tuning's parallelism
            list(ex.map(one, range(len(grid))))
    kind = {c: ratings.schema[c].dataType.simpleString() for c in ("fold", "user")}
    scored = (spark.read.schema(f"setting int, fold {kind['fold']}, user {kind['user']}, score double, is_pos int")
              .parquet(*[f"{root}/setting-{i}" for i in range(len(grid))]))
    auc = auc_per_user(scored.where("is_pos = 1"), scored.where("is_pos = 0"), ("setting", "fold", "user"))
    mean = auc.groupBy("setting", "fold").agg(F.avg("auc").alias("auc")).groupBy("setting").agg(F.avg("auc").alias("auc"))
    got = {r["setting"]: r["auc"] for r in mean.collect()}  # a row per setting
    return [got.get(i) for i in range(len(grid))]


#: items and users of a block
ITEM_BLOCK = 2048
USER_BLOCK = 2048


def _best_of_blocks(n: int):
    """One block of users against the item blocks of a round."""
    def run(left, right):
        import numpy as np
        import pyarrow as pa
        users = left.to_pylist()
        packed = [x for block in right.column("items").to_pylist() for x in block]
        ids = np.array([x["item"] for x in packed], np.int64)
        f = np.array([x["f"] for x in packed], float).reshape(len(ids), -1)
        # nothing later is longer than this round's shortest item
        shortest = float(np.linalg.norm(f, axis=1).min()) if len(ids) else 0.0
        out = []
        for u in users:
            item, score = np.array(u["items"], np.int64), np.array(u["scores"], float)
            if not u["done"] and len(ids):
                new = ~np.isin(ids, np.array(u["seen"], np.int64))
                item, score = np.concatenate([item, ids[new]]), np.concatenate([score, f[new] @ np.array(u["f"], float)])
                top = np.lexsort((item, -score))[:n]
                item, score = item[top], score[top]
            # Cauchy-Schwarz: no item of norm <= shortest can reach the n-th score (ties are let in)
            bound = shortest * float(np.linalg.norm(u["f"])) * (1 + 1e-9) + 1e-12
            done = bool(u["done"] or (len(score) == n and score[-1] > bound))
            out.append({**u, "items": item.tolist(), "scores": score.tolist(), "done": done})
        return pa.Table.from_pylist(out, schema=left.schema)
    return run


def top_n_for_users(model, users: DataFrame | None, seen: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` unseen items of the highest scores (ties to the smaller item)
    for each user in ``users``, or for all users of the model: (user, item,
    score, rank), exactly as scoring every item would give them.

    Items are taken in blocks of falling factor norm, one block in the first
    round and twice as many in each further one.  By Cauchy-Schwarz a user's scores of
    all later items are at most the product of the norms, so a user whose n-th
    score beats that is done, and most need few rounds.  Each round joins the
    open users, in blocks, with the round's items; the users' state is written
    in between.  A user's own seen items travel with the user.
    """
    from quarry.session import shared_dir
    spark = seen.sparkSession
    shared_dir(spark)
    items = model.itemFactors.select(F.col("id").cast("long").alias("item"), F.col("features").cast("array<double>").alias("f"))
    items = items.withColumn("norm", F.sqrt(F.aggregate("f", F.lit(0.0), lambda s, v: s + v * v)))
    place = item_index(items.select(F.struct((-F.col("norm")).alias("falling"), "item").alias("item")))
    items = (items.join(place.select(F.col("item.item").alias("item"), F.floor(F.col("idx") / ITEM_BLOCK).alias("block")), "item"))
    # a row for each block, of ITEM_BLOCK items at most
    items = items.groupBy("block").agg(F.collect_list(F.struct("item", "f")).alias("items")).checkpoint()
    blocks = items.agg(F.max("block")).first()[0]
    uf = model.userFactors.select(F.col("id").cast("long").alias("user"), F.col("features").cast("array<double>").alias("f"))
    if users is not None:
        uf = uf.join(users.select(F.col("user").cast("long").alias("user")).distinct(), "user")
    own = seen.groupBy(F.col("user").cast("long").alias("user")).agg(F.collect_set(F.col("item").cast("long")).alias("seen"))
    none = F.array().cast("array<bigint>")
    user_blocks = max(1, -(-uf.count() // USER_BLOCK))
    share = F.pmod(F.xxhash64("user"), F.lit(user_blocks)).alias("ub")
    state = uf.join(own, "user", "left").select(
        share, "user", "f", F.coalesce("seen", none).alias("seen"), none.alias("items"),
        F.array().cast("array<double>").alias("scores"), F.lit(False).alias("done")).checkpoint()
    at, step, finished = 0, 1, None
    while blocks is not None and at <= blocks:
        open_ = state.where(~F.col("done"))
        # every open user block meets every item of the round, once
        dealt = (items.where(F.col("block").between(at, at + step - 1))
                 .select("items", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(user_blocks - 1).cast("long"))).alias("to"))
                 .join(open_.select(F.col("ub").alias("to")).distinct(), "to", "left_semi"))
        nxt = open_.groupBy("ub").cogroup(dealt.groupBy("to")).applyInArrow(_best_of_blocks(n), open_.schema).checkpoint()
        done = nxt.where("done").select("user", "items", "scores")
        finished = done if finished is None else finished.unionByName(done)
        state = nxt
        at, step = at + step, step * 2
        if state.where(~F.col("done")).limit(1).count() == 0:
            break
    rest = state.where(~F.col("done")).select("user", "items", "scores")
    every = rest if finished is None else finished.unionByName(rest)
    return (every.select("user", F.posexplode(F.arrays_zip("items", "scores")).alias("pos", "x"))
            .select("user", F.col("x.items").alias("item"), F.col("x.scores").alias("score"), (F.col("pos") + 1).alias("rank")))
