"""Risk queries: calendar fill, returns, factor statistics, regressions, VaR, bootstrap, KDE."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import risk, tiles
from quarry.plans import roles
from quarry.plans.registry import query
from quarry.session import stand_in_source
from quarry.sources import formats


def _filled(spark, d, factors=False):
    q = roles.factor_quotes(spark, d) if factors else roles.stock_quotes(spark, d)
    return risk.fill_calendar(q, roles.RISK_START, roles.RISK_END)


def _returns(spark, d, factors=False):
    """10-day returns, written once to the shared folder: several branches
    (covariance, means, features, regressions, scalar bounds) read them, and
    each re-read would otherwise re-scan and re-aggregate the orders."""
    return risk.horizon_returns(_filled(spark, d, factors), 10).checkpoint()


@query("bday_fill")
def bday_fill(spark, d):
    # prices are exact (integer cents summed, one division): identical in any
    # engine, so they are returned as is - no rounding rule to disagree on
    return _filled(spark, d).select("instrument", "date", "price")


@query("horizon_returns")
def horizon_returns(spark, d):
    # one reader only: nothing is written
    r = risk.horizon_returns(_filled(spark, d), 10)
    return r.select("instrument", "date", F.round("ret", 8).alias("ret"))


@query("factor_matrix")
def factor_matrix(spark, d):
    fr = risk.horizon_returns(_filled(spark, d, True), 10).withColumn("ret", F.round("ret", 8))
    return risk.factor_matrix(fr, roles.SEGMENTS)


@query("factor_cov")
def factor_cov(spark, d):
    c = risk.factor_cov(_returns(spark, d, True))
    return c.select("factor_a", "factor_b", F.round("cov", 10).alias("cov"))


@query("factor_features")
def factor_features(spark, d):
    f = risk.factor_features(_returns(spark, d, True))
    return f.select("date", F.posexplode("features").alias("idx", "value")) \
        .select("date", "idx", F.round("value", 8).alias("value"))


@query("factor_beta")
def factor_beta(spark, d):
    b = risk.factor_beta(_returns(spark, d), _returns(spark, d, True))
    return b.select("instrument", "factor", F.round("beta", 6).alias("beta"), F.round("alpha", 6).alias("alpha"))


@query("instrument_ols")
def instrument_ols(spark, d):
    feats = risk.factor_features(_returns(spark, d, True))
    return risk.instrument_ols(_returns(spark, d), feats)


def _scenarios(spark, d):
    fr = _returns(spark, d, True)
    names, means, chol = risk.cholesky_params(risk.factor_cov(fr), risk.factor_means(fr))
    ols = risk.instrument_ols(_returns(spark, d), risk.factor_features(fr))
    w = ols.groupBy("idx").agg(F.avg("coef").alias("w")).orderBy("idx").collect()
    if len(w) != 3 * len(names):
        raise ValueError("weights do not match the factor features")
    return risk.scenario_returns(roles.trials(spark, d), means, chol, [r["w"] for r in w])


@query("scenario_returns")
def scenario_returns(spark, d):
    return _scenarios(spark, d)


@query("scenario_returns_fine")
def scenario_returns_fine(spark, d):
    """Some 625 factors (nation, segment, priority), covariance and draws by
    tiles, valued for a portfolio by order value."""
    q = risk.fill_calendar(roles.fine_factor_quotes(spark, d), roles.RISK_START, roles.RISK_END)
    fr = risk.horizon_returns(q, 10).checkpoint()
    index = tiles.factor_index(fr)
    low = tiles.cholesky_tiles(tiles.covariance_tiles(fr, index), index.count())
    return tiles.tiled_scenario_returns(roles.trials(spark, d), low, risk.factor_means(fr),
                                        roles.fine_factor_weights(spark, d), index)


@query("price_folder")
def price_folder(spark, d):
    """Per-instrument price files read back and filled onto the calendar."""
    path = stand_in_source(spark, "prices", d, lambda p: roles.price_files(spark, d, p))
    q = formats.price_folder(spark, path, "dd-MMM-yyyy", folders=True)
    return risk.fill_calendar(q, roles.RISK_START, roles.RISK_END).select("instrument", "date", "price")


@query("scenario_var")
def scenario_var(spark, d):
    return risk.var_cvar(_scenarios(spark, d))


@query("var_cvar")
def var_cvar(spark, d):
    """Historical 5 % VaR / CVaR of the pooled 10-day returns."""
    v = risk.var_cvar(_returns(spark, d))
    return v.select(F.round("var", 8).alias("var"), F.round("cvar", 8).alias("cvar"))


def _hist_keyed(spark, d):
    r = _returns(spark, d)
    return r.select(F.concat_ws("|", "instrument", F.col("date").cast("string")).alias("key"), "ret")


@query("bootstrap_ci")
def bootstrap_ci(spark, d):
    b = risk.bootstrap_var_cvar(_hist_keyed(spark, d), replicates=100, seed=7, key="key")
    lo_hi_v = risk.confidence_interval(b, "var", 0.05)
    lo_hi_c = risk.confidence_interval(b.withColumnRenamed("var", "_v").withColumnRenamed("cvar", "var"),
                                       "var", 0.05)
    out = lo_hi_v.select(F.lit("var").alias("stat"), "lower", "upper").unionByName(
        lo_hi_c.select(F.lit("cvar").alias("stat"), "lower", "upper"))
    return out.select("stat", F.round("lower", 8).alias("lower"), F.round("upper", 8).alias("upper"))


@query("return_kde")
def return_kde(spark, d):
    k = risk.kde(_returns(spark, d), "ret", 100, 1.0)
    return k.select("i", F.round("x", 8).alias("x"), F.round("density", 8).alias("density"))
