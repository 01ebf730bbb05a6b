"""Portfolio risk: price series on a business-day calendar, horizon returns,
factor statistics, per-instrument regressions, Monte Carlo scenarios, VaR /
CVaR with bootstrap confidence intervals, kernel density.

Series are long tables (instrument, date, price).  Everything is partitioned
by instrument or by trial; only small model parameters (a Cholesky factor of
the factor covariance, the averaged regression weights: both bounded by the
number of factors) are brought to the driver, and their size is checked.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.expr import box_muller, dot, hash_uniform, signed_sqrt, signed_square

MAX_FACTORS = 512  # bound on parameters brought to the driver


def daily_quotes(df: DataFrame, key: str, date: str, price: str, scale: int | None = None) -> DataFrame:
    """Mean price per (instrument, day).

    With ``scale`` (e.g. 100 for prices in cents) the mean is exact and
    independent of summation order: integer units are summed exactly and
    divided once, so every engine and every partitioning gives the same
    double."""
    g = df.groupBy(F.col(key).alias("instrument"), F.to_date(F.col(date)).alias("date"))
    if scale is None:
        return g.agg(F.avg(price).alias("price"))
    units = F.round(F.col(price) * F.lit(float(scale))).cast("long")
    return g.agg((F.sum(units).cast("double") / (F.count(F.lit(1)) * F.lit(scale)).cast("double")).alias("price"))


def fill_calendar(quotes: DataFrame, start: str, end: str) -> DataFrame:
    """Trim to [start, end], pad the start with the first in-range price, and
    forward-fill (as-of, backward) onto the Mon-Fri calendar [start, end).

    Weekend or repeated-date quotes are handled by the as-of rule: a calendar
    day takes the latest quote on or before it.  Instruments with no quote in
    range are dropped.  The calendar is generated per instrument (explode of a
    date sequence), so there is no join against a calendar table.
    """
    s, e = F.to_date(F.lit(start)), F.to_date(F.lit(end))
    q = quotes.where((F.col("date") >= s) & (F.col("date") <= e))
    first = q.groupBy("instrument").agg(F.min_by("price", "date").alias("first_price"))
    cal = (first.select("instrument", "first_price",
                        F.explode(F.sequence(s, F.date_sub(e, 1))).alias("date"))
           .where(F.dayofweek("date").between(2, 6))
           .withColumn("price", F.lit(None).cast("double")).withColumn("kind", F.lit(1)))
    qq = (q.join(first, "instrument").select("instrument", "first_price", "date", "price")
          .withColumn("kind", F.lit(0)))
    w = (Window.partitionBy("instrument").orderBy("date", "kind")
         .rowsBetween(Window.unboundedPreceding, 0))
    u = cal.unionByName(qq).withColumn("filled", F.last("price", ignorenulls=True).over(w))
    return (u.where(F.col("kind") == 1)
            .select("instrument", "date", F.coalesce("filled", "first_price").alias("price")))


def horizon_returns(filled: DataFrame, horizon: int = 10) -> DataFrame:
    """(last - first) / first over each run of ``horizon`` consecutive days;
    0 when first = 0.  A series of n days yields n - horizon + 1 returns."""
    w = Window.partitionBy("instrument").orderBy("date")
    last = F.lead("price", horizon - 1).over(w)
    r = filled.withColumn("_last", last).where(F.col("_last").isNotNull())
    ret = F.when(F.col("price") == 0, F.lit(0.0)).otherwise((F.col("_last") - F.col("price")) / F.col("price"))
    return r.select("instrument", "date", ret.alias("ret"))


def factor_matrix(factor_returns: DataFrame, factors: list[str]) -> DataFrame:
    """One row per date, one column per factor of the given list (aligned by
    date): the list fixes the schema and spares a job that looks for it."""
    return factor_returns.groupBy("date").pivot("instrument", factors).agg(F.first("ret"))


def factor_cov(factor_returns: DataFrame) -> DataFrame:
    """Sample covariance (ddof 1) of every ordered factor pair, aligned by date.
    The self-join is on date: its groups hold one row per factor."""
    a = factor_returns.select("date", F.col("instrument").alias("factor_a"), F.col("ret").alias("ra"))
    b = factor_returns.select("date", F.col("instrument").alias("factor_b"), F.col("ret").alias("rb"))
    return a.join(b, "date").groupBy("factor_a", "factor_b").agg(F.covar_samp("ra", "rb").alias("cov"))


def factor_means(factor_returns: DataFrame) -> DataFrame:
    return factor_returns.groupBy(F.col("instrument").alias("factor")).agg(F.avg("ret").alias("mean"))


def featurize_array(x) -> F.Column:
    """signed squares ++ signed square roots ++ raw values (3n features)."""
    return F.concat(F.transform(x, signed_square), F.transform(x, signed_sqrt), x)


def factor_vectors(factor_returns: DataFrame) -> DataFrame:
    """(date, x array<double>) with factors in name order; dates missing a
    factor are dropped.  Each group is one row per factor (bounded)."""
    nf = factor_returns.select(F.count_distinct("instrument")).scalar()
    g = (factor_returns.groupBy("date")
         .agg(F.array_sort(F.collect_list(F.struct("instrument", "ret"))).alias("v"))
         .where(F.size("v") == nf))
    return g.select("date", F.transform("v", lambda s: s["ret"]).alias("x"))


def factor_features(factor_returns: DataFrame) -> DataFrame:
    return factor_vectors(factor_returns).select("date", featurize_array(F.col("x")).alias("features"))


def _solve_moments(pdf: pd.DataFrame) -> pd.DataFrame:
    """Coefficients of one instrument from its moments: (features + 1)^2 rows,
    the return being the last variable."""
    n = int(pdf["i"].max()) + 1
    cov, mean = np.zeros((n, n)), np.zeros(n)
    i, j = pdf["i"].to_numpy(), pdf["j"].to_numpy()
    cov[i, j] = cov[j, i] = pdf["cov"].to_numpy()
    mean[i] = pdf["mean_i"].to_numpy()
    sd = np.sqrt(np.diag(cov))[:-1]
    sd = np.where(sd > 0, sd, 1.0)
    x, *_ = np.linalg.lstsq(cov[:-1, :-1] / np.outer(sd, sd), cov[:-1, -1] / sd, rcond=None)
    coef = x / sd
    return pd.DataFrame({"instrument": pdf["instrument"].iloc[0], "idx": np.arange(n - 1, dtype=np.int32),
                         "coef": coef, "intercept": mean[-1] - coef @ mean[:-1]})


def instrument_ols(stock_returns: DataFrame, features: DataFrame) -> DataFrame:
    """Least squares of each instrument's returns on the factor features, with
    an intercept that is fitted and reported apart (valuation drops it).

    Normal equations: the covariances of all pairs of (features, return) are
    one aggregation over the days, partial on the map side; what is solved per
    instrument is their small matrix, however long the calendar.
    """
    x = (stock_returns.join(features, "date")
         .select("instrument", F.concat("features", F.array("ret")).alias("x")))
    x = x.select("instrument", F.posexplode("x").alias("i", "a"), "x")
    x = x.select("instrument", "i", "a", F.explode(F.transform(
        F.slice("x", F.col("i") + 1, F.size("x")), lambda b, k: F.struct((k + F.col("i")).alias("j"), b.alias("b")))).alias("o"))
    moments = x.groupBy("instrument", "i", F.col("o.j").alias("j")).agg(
        F.covar_pop("a", "o.b").alias("cov"), F.avg("a").alias("mean_i"))
    return moments.groupBy("instrument").applyInPandas(
        _solve_moments, "instrument string, idx int, coef double, intercept double")


def factor_beta(stock_returns: DataFrame, factor_returns: DataFrame) -> DataFrame:
    """One-factor OLS slope and intercept per (instrument, factor)."""
    f = factor_returns.select("date", F.col("instrument").alias("factor"), F.col("ret").alias("x"))
    s = stock_returns.select("date", "instrument", F.col("ret").alias("y"))
    return (s.join(f, "date").groupBy("instrument", "factor")
            .agg(F.regr_slope("y", "x").alias("beta"), F.regr_intercept("y", "x").alias("alpha")))


def cholesky_params(cov: DataFrame, means: DataFrame):
    """Small parameters to the driver: factor names, means, Cholesky factor.
    Bounded by MAX_FACTORS (checked)."""
    m = means.orderBy("factor").limit(MAX_FACTORS + 1).collect()
    if len(m) > MAX_FACTORS:
        raise ValueError("too many factors for an in-row scenario draw")
    names = [r["factor"] for r in m]
    pos = {n: i for i, n in enumerate(names)}
    c = np.zeros((len(names), len(names)))
    for r in cov.where(F.col("factor_a").isin(names) & F.col("factor_b").isin(names)).collect():
        c[pos[r["factor_a"]], pos[r["factor_b"]]] = r["cov"]
    jitter = 1e-12 * max(1.0, float(np.trace(c)))
    chol = np.linalg.cholesky(c + jitter * np.eye(len(names)))
    return names, [float(r["mean"]) for r in m], chol


def scenario_returns(trials: DataFrame, means: list[float], chol: np.ndarray,
                     mean_weights: list[float], seed: int = 1496) -> DataFrame:
    """Value every trial: correlated factor draw f = mu + L z with z standard
    normals from a hash of (trial, factor, seed) (reproducible anywhere),
    featurised, dotted with the instrument-averaged weights (the mean over
    instruments of w . x equals (mean w) . x).  One row in, one row out."""
    n = len(means)
    z = F.array(*[box_muller(hash_uniform(F.col("trial"), F.lit(j), F.lit(seed), F.lit("a")),
                             hash_uniform(F.col("trial"), F.lit(j), F.lit(seed), F.lit("b")))
                  for j in range(n)])
    # the factor matrix is one array value, whatever the number of factors
    table = F.array(*[F.struct(F.lit(float(means[i])).alias("m"), F.lit([float(v) for v in chol[i]]).alias("row"))
                      for i in range(n)])
    f = F.transform(table, lambda t: t["m"] + dot(t["row"], F.col("z")))
    w = F.array(*[F.lit(float(x)) for x in mean_weights])
    return (trials.select("trial", z.alias("z"))
            .select("trial", dot(w, featurize_array(f)).alias("ret")))


# ------------------------------------------------------------ exact selection

def select_kth(df: DataFrame, k: DataFrame, group: str = "grp", value: str = "v",
               weight: str = "w", buckets: int = 4096) -> DataFrame:
    """Exact weighted k-th smallest value per group, fully distributed.

    ``df`` has (group, value, weight > 0); ``k`` has (group, k).  Each pass
    aggregates the rows inside every group's current value range into
    ``buckets`` equal-width buckets (a partial/final aggregation, no sort) and
    narrows the range to the bucket holding the k-th unit of weight; it stops
    when that bucket holds a single distinct value.  The per-group state is a
    few numbers per group, checkpointed each pass.

    Returns (group, kth, sum_below, weight_below): the k-th value, and the
    weighted sum / weight of values strictly below the final range, so the
    mean of the k smallest is (sum_below + (k - weight_below) * kth) / k.
    """
    from quarry.session import shared_dir
    shared_dir(df.sparkSession)  # checkpoint() needs the shared folder
    B = float(buckets)
    # The (group, value, weight) table is read once per pass: cut its lineage
    # (written to the shared checkpoint folder) so a pass never recomputes it.
    d = df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v"),
                  F.col(weight).cast("double").alias("w")).checkpoint()
    st = (d.groupBy("g").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
          .join(k.select(F.col(group).alias("g"), F.col("k").cast("double").alias("k")), "g")
          .select("g", "lo", "hi", F.col("k").alias("krem"), "k",
                  F.lit(0.0).alias("sb"), F.lit(0.0).alias("wb"),
                  (F.col("lo") == F.col("hi")).alias("done"))).checkpoint()
    # No pass cap: while lo < hi the range minimum and maximum fall in
    # different buckets, so every pass leaves fewer distinct values in range
    # and the loop ends (a handful of passes for doubles in practice).
    while st.where(~F.col("done")).limit(1).count() > 0:
        open_ = st.where(~F.col("done")).select("g", "lo", "hi")
        span = F.col("hi") - F.col("lo")
        b = F.least(F.floor((F.col("v") - F.col("lo")) / span * B), F.lit(B - 1)).cast("int")
        # open_ holds one row per unresolved group (bounded by the group count)
        agg = (d.join(F.broadcast(open_), "g")
               .where((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
               .groupBy("g", b.alias("b"))
               .agg(F.sum("w").alias("bw"), F.sum(F.col("w") * F.col("v")).alias("bs"),
                    F.min("v").alias("bmin"), F.max("v").alias("bmax")))
        wb = Window.partitionBy("g").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
        agg = (agg.withColumn("cw", F.coalesce(F.sum("bw").over(wb), F.lit(0.0)))
               .withColumn("cs", F.coalesce(F.sum("bs").over(wb), F.lit(0.0))))
        pick = (agg.join(st.where(~F.col("done")).select("g", "krem"), "g")
                .where((F.col("cw") < F.col("krem")) & (F.col("krem") <= F.col("cw") + F.col("bw")))
                .select("g", F.col("bmin").alias("n_lo"), F.col("bmax").alias("n_hi"),
                        F.col("cw").alias("n_cw"), F.col("cs").alias("n_cs")))
        st = (st.join(pick, "g", "left").select(
            "g", "k",
            F.coalesce("n_lo", "lo").alias("lo"), F.coalesce("n_hi", "hi").alias("hi"),
            (F.col("krem") - F.coalesce("n_cw", F.lit(0.0))).alias("krem"),
            (F.col("sb") + F.coalesce("n_cs", F.lit(0.0))).alias("sb"),
            (F.col("wb") + F.coalesce("n_cw", F.lit(0.0))).alias("wb"),
            (F.col("done") | (F.coalesce("n_lo", "lo") == F.coalesce("n_hi", "hi"))).alias("done"))
              .checkpoint())
    return st.select(F.col("g").alias(group), F.col("lo").alias("kth"),
                     F.col("sb").alias("sum_below"), F.col("wb").alias("weight_below"), "k")


def var_cvar_from_selection(sel: DataFrame) -> DataFrame:
    """VaR = k-th smallest; CVaR = mean of the k smallest."""
    cvar = (F.col("sum_below") + (F.col("k") - F.col("weight_below")) * F.col("kth")) / F.col("k")
    return sel.select("*", F.col("kth").alias("var"), cvar.alias("cvar"))


def tail_k(total_weight) -> F.Column:
    """k = max(floor(n / 20), 1): the 5 % tail size."""
    return F.greatest(F.floor(total_weight / F.lit(20.0)), F.lit(1.0))


def var_cvar(returns: DataFrame, value: str = "ret") -> DataFrame:
    d = returns.select(F.lit(0).alias("grp"), F.col(value).alias("v"), F.lit(1.0).alias("w"))
    k = d.groupBy("grp").agg(tail_k(F.sum("w")).alias("k"))
    return var_cvar_from_selection(select_kth(d, k)).select("var", "cvar")


# Cumulative Poisson(1) probabilities P(X <= j), j = 0..7
# (the remaining mass, 1e-6, maps to 8).
POISSON1_CDF = [0.36787944117144233, 0.7357588823428847, 0.9196986029286058,
                0.9810118431238462, 0.9963401531726563, 0.9994058151824183,
                0.9999167588507119, 0.9999897508033253]


def poisson1(u: F.Column) -> F.Column:
    """Poisson(1) draw by inverse CDF from a uniform."""
    expr = F.lit(8)
    for j in reversed(range(len(POISSON1_CDF))):
        expr = F.when(u <= F.lit(POISSON1_CDF[j]), F.lit(j)).otherwise(expr)
    return expr


#: steps of the tail histogram, and the share of the values it first covers
TAIL_STEPS = 32
TAIL_SHARE = 0.06


def _draws(key: F.Column, replicates: int, seed: int) -> F.Column:
    """A row's count in each replicate, as an array."""
    return F.transform(F.sequence(F.lit(0), F.lit(replicates - 1)), lambda g: poisson1(hash_uniform(key, g, F.lit(seed))))


def _tail_histogram(rows: DataFrame, edges: list[float], replicates: int):
    """(v, counts) -> two arrays [bucket, replicate]: the count of rows and the
    sum of their values.  Bucket i holds edges[i-1] < v <= edges[i], the last
    one the rest.  Tasks add up their rows; what is shuffled and comes back are
    (steps + 1) x replicates cells."""
    import numpy as np
    import pyarrow as pa

    def run(batches):
        n = len(edges) + 1
        count, total = np.zeros((n, replicates)), np.zeros((n, replicates))
        for batch in batches:
            v = batch.column("v").to_numpy()
            if not len(v):
                continue
            w = batch.column("w").flatten().to_numpy().reshape(len(v), replicates)
            b = np.searchsorted(edges, v, side="left")
            order = np.argsort(b, kind="stable")
            at, first = np.unique(b[order], return_index=True)
            w = w[order].astype(float)
            count[at] += np.add.reduceat(w, first)
            total[at] += np.add.reduceat(w * v[order][:, None], first)
        some = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some[0]), pa.array(some[1]), pa.array(count[some]), pa.array(total[some])],
                                         names=["b", "g", "n", "s"])
    cells = (rows.mapInArrow(run, "b long, g long, n double, s double").groupBy("b", "g")
             .agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect())
    count, total = np.zeros((len(edges) + 1, replicates)), np.zeros((len(edges) + 1, replicates))
    for c in cells:
        count[c["b"], c["g"]], total[c["b"], c["g"]] = c["n"], c["s"]
    return count, total


def bootstrap_var_cvar(returns: DataFrame, replicates: int = 100, seed: int = 7, key: str = "trial",
                       value: str = "ret", share: float = TAIL_SHARE) -> DataFrame:
    """VaR and CVaR of each Poisson bootstrap replicate: every row gets a
    Poisson(1) count per replicate from a hash of (row key, replicate, seed).

    No resampled copies: one pass adds each row's counts into a histogram of
    the lower tail (edges at quantiles up to ``share`` of the values).  Running
    sums over its buckets prove, for each replicate, which bucket holds the
    k-th smallest value; if the histogram does not reach it for some replicate,
    it is made anew over twice the share.  Only rows of those buckets are then
    expanded into (replicate, value, count), and the k-th value is selected
    among them.  Null and NaN returns take no part; a replicate without rows
    is left out.  Returns (replicate, var, cvar).
    """
    import numpy as np
    from quarry.session import shared_dir
    spark = returns.sparkSession
    shared_dir(spark)
    d = (returns.select(F.col(key).alias("key"), F.col(value).cast("double").alias("v"))
         .where(F.col("v").isNotNull() & ~F.isnan("v")).checkpoint())
    counted = d.select("v", _draws(F.col("key"), replicates, seed).alias("w"))
    empty = spark.createDataFrame([], "replicate int, var double, cvar double")
    while True:
        steps = [min(1.0, share) * (i + 1) / TAIL_STEPS for i in range(TAIL_STEPS)]
        edges = d.agg(F.percentile_approx("v", steps, 10_000)).first()[0]
        if edges is None:
            return empty
        edges = sorted(set(edges))
        if share >= 1.0:
            edges.append(float("inf"))
        count, total = _tail_histogram(counted, edges, replicates)
        weight = count.sum(axis=0)
        k = np.maximum(np.floor(weight / 20.0), 1.0)
        through = count[:-1].cumsum(axis=0)
        live = weight > 0
        if (through[-1] >= k)[live].all():
            break
        share *= 2
    # the bucket of each replicate's k-th value, and what lies below it
    at = (through < k).sum(axis=0)
    bounds = [float("-inf"), *edges]
    rows = []
    for g in np.flatnonzero(live):
        b = at[g]
        rows.append((int(g), float(bounds[b]), float(bounds[b + 1]), float(k[g]),
                     float(count[:b, g].sum()), float(total[:b, g].sum())))
    if not rows:
        return empty
    place = spark.createDataFrame(rows, "grp int, lo double, hi double, k double, below double, sum double")
    inside = F.transform(F.lit([r[1] for r in rows]), lambda lo, i: F.struct(
        F.get(F.lit([r[0] for r in rows]), i).alias("grp"), lo.alias("lo"), F.get(F.lit([r[2] for r in rows]), i).alias("hi")))
    near = d.where((F.col("v") > min(r[1] for r in rows)) & (F.col("v") <= max(r[2] for r in rows)))
    near = near.select("v", F.explode(F.filter(F.transform(
        F.filter(inside, lambda x: (F.col("v") > x["lo"]) & (F.col("v") <= x["hi"])),
        lambda x: F.struct(x["grp"].alias("grp"), poisson1(hash_uniform(F.col("key"), x["grp"], F.lit(seed))).alias("w"))),
        lambda x: x["w"] > 0)).alias("x")).select("v", "x.grp", "x.w")
    s = select_kth(near, place.select("grp", (F.col("k") - F.col("below")).alias("k")))
    s = s.drop("k").join(place, "grp").select(
        "grp", "kth", (F.col("sum_below") + F.col("sum")).alias("sum_below"),
        (F.col("weight_below") + F.col("below")).alias("weight_below"), "k")
    return var_cvar_from_selection(s).select(F.col("grp").alias("replicate"), "var", "cvar")


def confidence_interval(stats: DataFrame, col: str, p: float = 0.05) -> DataFrame:
    """(lower, upper) of a statistic over n replicates: the sorted values at
    positions int(n*p/2 - 1) and ceil(n*(1 - p/2)) (0-based), as in the
    classic percentile bootstrap; n is the replicate count (small)."""
    # One row per replicate (a small, parameter-bounded table).
    w = Window.partitionBy(F.lit(0)).orderBy(F.col(col), F.col("replicate"))
    n = stats.select(F.count(F.lit(1)).cast("double")).scalar()
    lo_i = F.floor(n * F.lit(p / 2) - F.lit(1.0))
    hi_i = F.ceil(n * F.lit(1 - p / 2))
    r = stats.select(col, (F.row_number().over(w) - 1).alias("i"))
    return r.agg(F.max(F.when(F.col("i") == lo_i, F.col(col))).alias("lower"),
                 F.max(F.when(F.col("i") == hi_i, F.col(col))).alias("upper"))


def kde(samples: DataFrame, value: str = "ret", points: int = 100,
        bandwidth: float = 1.0) -> DataFrame:
    """Gaussian kernel density on ``points`` evenly spaced grid points from min
    to max (step (max - min) / points).  Each sample row is expanded over the
    grid by a generator and averaged per grid point (partial aggregation)."""
    lo = samples.select(F.min(value)).scalar()
    hi = samples.select(F.max(value)).scalar()
    step = (hi - lo) / F.lit(float(points))
    g = samples.select(F.col(value).alias("s"),
                       F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    x = lo + F.col("i") * step
    z = (x - F.col("s")) / F.lit(bandwidth)
    dens = F.exp(F.lit(-0.5) * z * z) / F.lit(bandwidth * math.sqrt(2 * math.pi))
    return (g.groupBy("i").agg(F.avg(dens).alias("density"))
            .select("i", (lo + F.col("i") * step).alias("x"), "density"))
