"""Rows-only queries checked against brute force on the smallest fixture."""
import hashlib
import math

import numpy as np

from conftest import SMOKE


def test_instrument_ols_equals_lstsq(spark):
    from quarry.operators import risk
    from quarry.plans import catalog
    fr = catalog._returns(spark, SMOKE, True)
    sr = catalog._returns(spark, SMOKE)
    feats = {r.date: np.array(r.features) for r in risk.factor_features(fr).collect()}
    got = {}
    for r in risk.instrument_ols(sr, risk.factor_features(fr)).collect():
        got.setdefault(r.instrument, {})[r.idx] = (r.coef, r.intercept)
    by = {}
    for r in sr.collect():
        if r.date in feats:
            by.setdefault(r.instrument, []).append((feats[r.date], r.ret))
    for inst, rows in by.items():
        x = np.vstack([f for f, _ in rows])
        y = np.array([v for _, v in rows])
        coef, *_ = np.linalg.lstsq(np.hstack([np.ones((len(y), 1)), x]), y, rcond=None)
        mine = got[inst]
        assert np.allclose([mine[i][0] for i in range(len(coef) - 1)], coef[1:], atol=1e-6)
        assert math.isclose(mine[0][1], coef[0], abs_tol=1e-6)


def _u(*parts):
    h = int(hashlib.md5("|".join(str(p) for p in parts).encode()).hexdigest()[:8], 16)
    return (h + 0.5) / 2 ** 32


def test_scenario_values_equal_python(spark):
    from pyspark.sql import functions as F
    from quarry.operators import risk
    means, chol, w = [0.01, -0.02], np.array([[0.1, 0.0], [0.05, 0.2]]), [0.5, -1.0, 0.25, 2.0, 1.5, -0.5]
    trials = spark.range(50).select(F.col("id").alias("trial"))
    got = {r.trial: r.ret for r in risk.scenario_returns(trials, means, chol, w, seed=9).collect()}
    for t in range(50):
        z = [math.sqrt(-2 * math.log(_u(t, j, 9, "a"))) * math.cos(2 * math.pi * _u(t, j, 9, "b"))
             for j in range(2)]
        f = [means[i] + sum(chol[i, j] * z[j] for j in range(2)) for i in range(2)]
        feat = ([math.copysign(1, v) * v * v for v in f] + [math.copysign(1, v) * math.sqrt(abs(v)) for v in f] + f)
        assert math.isclose(got[t], sum(a * b for a, b in zip(w, feat)), rel_tol=1e-9, abs_tol=1e-12)


def test_kmeans_distance_equals_numpy(spark):
    import __spark_entry__ as entry
    from quarry.plans import catalog
    from quarry.plans import roles
    from quarry.sources.tables import table
    h, cut, model = catalog._anomaly_model(spark, SMOKE)
    feats = h.transform(roles.network_records(table(spark, SMOKE, "events")))
    used = cut.getIndices()
    centres = []  # in the full hashed space: 0 outside the used entries
    for c in model.clusterCenters():
        full = np.zeros(1 << 18)
        full[used] = c
        centres.append(full)
    got = {r.event_id: (r.cluster, r.distance) for r in entry.queries()["kmeans_assign"](spark, SMOKE).collect()}
    for r in feats.select("event_id", "features").limit(200).collect():
        v = r.features.toArray()
        d = [np.linalg.norm(v - c) for c in centres]
        c, dist = got[r.event_id]
        assert math.isclose(dist, round(d[c], 6), abs_tol=1e-6)
        assert d[c] <= min(d) + 1e-9
