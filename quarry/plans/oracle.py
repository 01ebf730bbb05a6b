"""DuckDB-runnable SQL equal to each registered query (tables are views)."""

from __future__ import annotations

from quarry.operators import lemmas

ORACLE: dict[str, str] = {}

_BASKETS = """
items AS (SELECT l.l_orderkey AS basket, p.p_name AS topic
          FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
dist AS (SELECT DISTINCT basket, topic AS item FROM items WHERE topic IS NOT NULL)
"""

ORACLE["topic_freq"] = f"""
WITH {_BASKETS}
SELECT topic, count(*) AS cnt FROM items GROUP BY topic
"""

ORACLE["freq_of_freq"] = f"""
WITH {_BASKETS}, f AS (SELECT topic, count(*) AS cnt FROM items GROUP BY topic)
SELECT cnt, count(*) AS dist FROM f GROUP BY cnt
"""

ORACLE["pair_counts"] = f"""
WITH {_BASKETS}
SELECT a.item AS topic_a, b.item AS topic_b, count(*) AS cnt
FROM dist a JOIN dist b ON a.basket = b.basket AND a.item < b.item
GROUP BY 1, 2
"""

ORACLE["hash_collisions"] = f"""
WITH {_BASKETS}
SELECT count(DISTINCT topic) AS unique_topics,
       count(DISTINCT substr(md5(topic), 1, 8)) AS unique_hashids
FROM items
"""

ORACLE["cooccurrence_chisq"] = f"""
WITH {_BASKETS},
pc AS (SELECT a.item AS topic_a, b.item AS topic_b, count(*) AS cnt
       FROM dist a JOIN dist b ON a.basket = b.basket AND a.item < b.item GROUP BY 1, 2),
m AS (SELECT item, count(*) AS n FROM dist GROUP BY item),
t AS (SELECT count(*)::DOUBLE AS t FROM orders),
x AS (SELECT pc.topic_a, pc.topic_b, pc.cnt, ma.n AS ya, mb.n AS yb, t.t,
             pc.cnt::DOUBLE AS yy
      FROM pc JOIN m ma ON ma.item = pc.topic_a JOIN m mb ON mb.item = pc.topic_b CROSS JOIN t),
c AS (SELECT *, t * pow(abs(yy * (t - (yb - yy) - (ya - yy) - yy) - (ya - yy) * (yb - yy)) - t / 2.0, 2)
               / nullif(ya * (t - ya) * yb * (t - yb), 0) AS chi
      FROM x)
SELECT topic_a, topic_b,
       least(substr(md5(topic_a), 1, 8), substr(md5(topic_b), 1, 8)) AS src,
       greatest(substr(md5(topic_a), 1, 8), substr(md5(topic_b), 1, 8)) AS dst,
       cnt, ya, yb, round(chi, 4) AS chisquare
FROM c WHERE chi > 3.84
"""


# ------------------------------------------------------------------ trips
def _zone_edges_sql() -> str:
    from quarry.plans.roles import ZONES
    rows = []
    for code, name, ring in ZONES:
        pts = list(ring) + [ring[0]]
        for (x1, y1), (x2, y2) in zip(pts[:-1], pts[1:]):
            rows.append(f"({code}, '{name}', {float(x1)}, {float(y1)}, {float(x2)}, {float(y2)})")
    return "zone_edges(zone_code, zone, x1, y1, x2, y2) AS (VALUES " + ", ".join(rows) + ")"


_TRIPS = """
ev AS (SELECT event_id, user_id, event_type, value, ts,
              CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
parsed AS (
  SELECT event_id AS trip_id, CAST(user_id AS VARCHAR) AS license,
         CASE WHEN event_type = 'error' THEN TIMESTAMP '1970-01-01 00:00:00'
              ELSE date_trunc('second', ts) END AS pickup_datetime,
         CASE WHEN event_type = 'error' THEN TIMESTAMP '1970-01-01 00:00:00'
              ELSE date_trunc('second', ts + to_microseconds(CAST(round(value * 60000000.0) AS BIGINT))) END
              AS dropoff_datetime,
         CASE WHEN event_type = 'view' AND value < 20 THEN 0.0 ELSE CAST(event_id % 100 AS DOUBLE) END AS pickup_x,
         CASE WHEN event_type = 'view' AND value < 20 THEN 0.0 ELSE CAST(k AS DOUBLE) END AS pickup_y,
         CASE WHEN event_type = 'view' AND value < 20 THEN 0.0 ELSE CAST(k AS DOUBLE) END AS dropoff_x,
         CASE WHEN event_type = 'view' AND value < 20 THEN 0.0 ELSE CAST(event_id % 100 AS DOUBLE) END AS dropoff_y,
         (event_type = 'error' OR (event_type = 'view' AND value < 20)) AS parsefailed
  FROM ev),
clean AS (
  SELECT *, (epoch_us(dropoff_datetime) - epoch_us(pickup_datetime)) / 60000000.0 AS duration_mins,
            (epoch_us(dropoff_datetime) - epoch_us(pickup_datetime)) / 60000000.0 / 60.0 AS duration_hours
  FROM parsed WHERE NOT parsefailed),
clean2 AS (SELECT * FROM clean WHERE duration_mins > 1 AND duration_hours < 3),
"""

_ZONED = """
areas AS (SELECT zone_code, zone, abs(sum(x1 * y2 - x2 * y1)) / 2.0 AS area FROM zone_edges GROUP BY 1, 2),
hits AS (
  SELECT c.trip_id, e.zone_code, e.zone
  FROM clean2 c JOIN zone_edges e
    ON ((e.y1 > c.dropoff_y) <> (e.y2 > c.dropoff_y))
   AND c.dropoff_x < e.x1 + (c.dropoff_y - e.y1) * (e.x2 - e.x1) / nullif(e.y2 - e.y1, 0)
  GROUP BY 1, 2, 3 HAVING count(*) % 2 = 1),
ranked AS (
  SELECT h.trip_id, h.zone, row_number() OVER (PARTITION BY h.trip_id
         ORDER BY h.zone_code, a.area DESC, h.zone) AS rn
  FROM hits h JOIN areas a USING (zone_code, zone)),
zoned AS (
  SELECT c.*, coalesce(r.zone, 'NA') AS zone
  FROM clean2 c LEFT JOIN ranked r ON r.trip_id = c.trip_id AND r.rn = 1),
done AS (
  SELECT * FROM zoned WHERE zone <> 'NA'
   AND NOT (pickup_x = 0 AND pickup_y = 0) AND NOT (dropoff_x = 0 AND dropoff_y = 0)),
nxt AS (
  SELECT *, lead(pickup_datetime) OVER (PARTITION BY license ORDER BY pickup_datetime, trip_id) AS next_pickup
  FROM done),
gaps AS (
  SELECT *, (epoch_us(next_pickup) - epoch_us(dropoff_datetime)) / 60000000.0 AS gap_mins
  FROM nxt WHERE next_pickup IS NOT NULL)
"""


def _trips_with(body: str, zoned: bool = False) -> str:
    head = "WITH " + _TRIPS
    if zoned:
        head += _zone_edges_sql() + ",\n" + _ZONED
    else:
        head = head.rstrip().rstrip(",")
    return head + "\n" + body


ORACLE["parse_good_bad"] = _trips_with("""
SELECT trip_id, license, pickup_datetime, dropoff_datetime, pickup_x, pickup_y, dropoff_x, dropoff_y,
       parsefailed FROM parsed""")

ORACLE["clean_durations"] = _trips_with("""
SELECT trip_id, license, round(duration_mins, 4) AS duration_mins, round(duration_hours, 4) AS duration_hours
FROM clean2""")

ORACLE["zone_lookup"] = _trips_with("SELECT trip_id, zone FROM zoned", zoned=True)

ORACLE["zone_counts"] = _trips_with(
    "SELECT zone, count(*) AS cnt FROM zoned WHERE zone <> 'NA' GROUP BY zone", zoned=True)

ORACLE["idle_within_shift"] = _trips_with("""
SELECT trip_id, license, zone, round(gap_mins, 4) AS gap_mins FROM gaps
WHERE gap_mins >= 0 AND gap_mins < 240""", zoned=True)

ORACLE["idle_between_shifts"] = _trips_with("""
SELECT trip_id, license, zone, round(gap_mins, 4) AS gap_mins FROM gaps
WHERE gap_mins >= 240""", zoned=True)

ORACLE["trip_sessions"] = _trips_with("""
, brk AS (
  SELECT trip_id, license, pickup_datetime,
         CASE WHEN (epoch_us(pickup_datetime) - epoch_us(lag(dropoff_datetime) OVER w)) / 3600000000.0 >= 4
              THEN 1 ELSE 0 END AS b
  FROM done WINDOW w AS (PARTITION BY license ORDER BY pickup_datetime, trip_id))
SELECT trip_id, license,
       CAST(sum(b) OVER (PARTITION BY license ORDER BY pickup_datetime, trip_id
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session
FROM brk""".lstrip(), zoned=True)

ORACLE["sliding_tuples"] = _trips_with("""
, w AS (
  SELECT license, trip_id AS first_id,
         list(trip_id) OVER (PARTITION BY license ORDER BY pickup_datetime, trip_id
                             ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS ids
  FROM done)
SELECT license, first_id, array_to_string(ids, ',') AS window_ids FROM w WHERE len(ids) = 3""".lstrip(),
    zoned=True)


# ---------------------------------------------------------------- linkage
_LINK = """
r AS (
  SELECT c_custkey AS id, c_nationkey AS block, c_mktsegment AS segment,
         CASE WHEN c_acctbal >= 0 THEN floor(c_acctbal / 1000.0) END AS f_band,
         right(c_name, 1) AS f_tail,
         CASE WHEN c_acctbal >= 0 THEN CAST(round(c_acctbal * 100.0) AS BIGINT) % 10 END AS f_cents
  FROM customer),
pairs AS (
  SELECT a.segment = b.segment AS matched,
         a.f_band AS a1, b.f_band AS b1, a.f_tail AS a2, b.f_tail AS b2, a.f_cents AS a3, b.f_cents AS b3
  FROM r a JOIN r b ON a.block = b.block AND a.id < b.id),
scores AS (
  SELECT matched, 'f_band' AS field,
         CASE WHEN a1 IS NULL OR b1 IS NULL THEN NULL WHEN a1 = b1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS s
  FROM pairs
  UNION ALL
  SELECT matched, 'f_tail',
         CASE WHEN a2 IS NULL OR b2 IS NULL THEN NULL WHEN a2 = b2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END FROM pairs
  UNION ALL
  SELECT matched, 'f_cents',
         CASE WHEN a3 IS NULL OR b3 IS NULL THEN NULL WHEN a3 = b3 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END FROM pairs),
vals AS (
  SELECT 'f_band' AS field, CAST(f_band AS VARCHAR) AS value FROM r
  UNION ALL SELECT 'f_tail', f_tail FROM r
  UNION ALL SELECT 'f_cents', CAST(f_cents AS VARCHAR) FROM r)
"""

ORACLE["header_and_bad_rows"] = """
SELECT c_custkey AS id, c_nationkey AS block,
       CASE WHEN c_acctbal >= 0 THEN floor(c_acctbal / 1000.0) END AS f_band,
       right(c_name, 1) AS f_tail,
       CAST(CASE WHEN c_acctbal >= 0 THEN CAST(round(c_acctbal * 100.0) AS BIGINT) % 10 END AS INTEGER) AS f_cents,
       c_mktsegment AS segment
FROM customer
"""

ORACLE["match_counts"] = f"""
WITH {_LINK}
SELECT matched, count(*) AS cnt FROM pairs GROUP BY matched
"""

ORACLE["missing_stats"] = f"""
WITH {_LINK}
SELECT matched, field, count(s) AS cnt, count(*) - count(s) AS missing,
       round(avg(s), 4) AS mean, round(stddev_pop(s), 4) AS stdev,
       round(min(s), 4) AS min, round(max(s), 4) AS max
FROM scores GROUP BY matched, field
"""

ORACLE["match_weights"] = f"""
WITH {_LINK},
m AS (SELECT field, avg(CASE WHEN s = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS m
      FROM scores WHERE matched GROUP BY field),
p AS (SELECT field, value, count(*) / (SELECT count(*) FROM customer)::DOUBLE AS p
      FROM vals WHERE value IS NOT NULL GROUP BY field, value),
u AS (SELECT field, sum(p * p) AS u FROM p GROUP BY field),
x AS (SELECT field, m, u, (m > 0 AND m < 1 AND u > 0 AND u < 1) AS ok FROM m JOIN u USING (field))
SELECT field, round(m, 4) AS m, round(u, 4) AS u,
       round(CASE WHEN ok THEN m / u END, 4) AS match_ratio,
       round(CASE WHEN ok THEN log2(m / u) END, 4) AS match_weight,
       round(CASE WHEN ok THEN (1 - m) / (1 - u) END, 4) AS nonmatch_ratio,
       round(CASE WHEN ok THEN log2((1 - m) / (1 - u)) END, 4) AS nonmatch_weight
FROM x
"""

_PAIRS = """
pair AS (SELECT a.c_custkey AS id1, a.c_mktsegment = b.c_mktsegment AS matched,
                a.c_acctbal >= 0 AND b.c_acctbal >= 0 AS ok,
                CAST(round(a.c_acctbal * 100.0) AS BIGINT) AS ca, CAST(round(b.c_acctbal * 100.0) AS BIGINT) AS cb,
                a.c_nationkey AS na, b.c_nationkey AS nb, a.c_name AS xa, b.c_name AS xb,
                a.c_acctbal AS ba, b.c_acctbal AS bb
         FROM customer a JOIN customer b ON b.c_custkey = a.c_custkey + 1),
score AS (
  SELECT matched, 0 AS pos, (na = nb)::INT::DOUBLE AS s FROM pair
  UNION ALL SELECT matched, 1, (na % 5 = nb % 5)::INT FROM pair
  UNION ALL SELECT matched, 2, (right(xa, 1) = right(xb, 1))::INT FROM pair
  UNION ALL SELECT matched, 3, (id1 // 10 = (id1 + 1) // 10)::INT FROM pair
  UNION ALL SELECT matched, 4, CASE WHEN ok THEN greatest(0, 100 - floor(abs(ca - cb) / 10000.0)) / 100.0 END FROM pair
  UNION ALL SELECT matched, 5, CASE WHEN ok THEN (floor(ba / 1000.0) = floor(bb / 1000.0))::INT END FROM pair
  UNION ALL SELECT matched, 6, CASE WHEN ok THEN (ca % 10 = cb % 10)::INT END FROM pair
  UNION ALL SELECT matched, 7, ((ba >= 0) = (bb >= 0))::INT FROM pair
  UNION ALL SELECT matched, 8, CASE WHEN na < 20 THEN (substr(xa, -2, 1) = substr(xb, -2, 1))::INT END FROM pair)"""

ORACLE["pair_scores"] = f"""
WITH {_PAIRS}
SELECT matched, pos, count(s) AS cnt, count(*) - count(s) AS missing, round(avg(s), 4) AS mean,
       round(stddev_pop(s), 4) AS stdev, round(min(s), 4) AS min, round(max(s), 4) AS max
FROM score GROUP BY matched, pos
"""

ORACLE["pair_weights"] = f"""
WITH {_PAIRS},
f AS (SELECT pos, count(*) FILTER (WHERE s = 1) / count(*)::DOUBLE AS u,
             count(*) FILTER (WHERE s = 1 AND matched) / (count(*) FILTER (WHERE matched))::DOUBLE AS m
      FROM score GROUP BY pos),
x AS (SELECT *, (m > 0 AND m < 1 AND u > 0 AND u < 1) AS ok FROM f)
SELECT ['s_nation', 's_zone', 's_name', 's_decade', 's_balance', 's_band', 's_cents', 's_sign', 's_tens'][pos + 1] AS field,
       round(m, 4) AS m, round(u, 4) AS u,
       round(CASE WHEN ok THEN m / u END, 4) AS match_ratio,
       round(CASE WHEN ok THEN log2(m / u) END, 4) AS match_weight,
       round(CASE WHEN ok THEN (1 - m) / (1 - u) END, 4) AS nonmatch_ratio,
       round(CASE WHEN ok THEN log2((1 - m) / (1 - u)) END, 4) AS nonmatch_weight
FROM x
"""

ORACLE["xml_topics"] = """
SELECT l.l_orderkey AS basket, p.p_name AS topic
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey WHERE l.l_quantity >= 25
"""


# ------------------------------------------------------------------- risk
def _series(name: str, src: str) -> str:
    from quarry.plans.roles import RISK_END, RISK_START
    import datetime as _dt
    last_day = (_dt.date.fromisoformat(RISK_END) - _dt.timedelta(days=1)).isoformat()
    return f"""
{name}_q AS (SELECT * FROM ({src}) s
             WHERE date >= DATE '{RISK_START}' AND date <= DATE '{RISK_END}'),
{name}_first AS (SELECT instrument, arg_min(price, date) AS first_price FROM {name}_q GROUP BY 1),
{name}_cal AS (SELECT f.instrument, f.first_price, CAST(t.d AS DATE) AS date
               FROM {name}_first f,
                    generate_series(TIMESTAMP '{RISK_START}', TIMESTAMP '{last_day}', INTERVAL 1 DAY) t(d)
               WHERE isodow(t.d) <= 5),
{name}_filled AS (SELECT c.instrument, c.date, coalesce(q.price, c.first_price) AS price
                  FROM {name}_cal c ASOF LEFT JOIN {name}_q q
                  ON c.instrument = q.instrument AND c.date >= q.date),
{name}_ret AS (SELECT instrument, date,
                      CASE WHEN price = 0 THEN 0.0 ELSE (l - price) / price END AS ret
               FROM (SELECT *, lead(price, 9) OVER (PARTITION BY instrument ORDER BY date) AS l
                     FROM {name}_filled) x WHERE l IS NOT NULL)"""


_STOCK_SRC = """SELECT o_orderpriority AS instrument, CAST(o_orderdate AS DATE) AS date,
                       CAST(sum(CAST(round(o_totalprice * 100.0) AS BIGINT)) AS DOUBLE)
                         / CAST(count(*) * 100 AS DOUBLE) AS price FROM orders GROUP BY 1, 2"""
_FACTOR_SRC = """SELECT c_mktsegment AS instrument, CAST(o_orderdate AS DATE) AS date,
                        CAST(sum(CAST(round(o_totalprice * 100.0) AS BIGINT)) AS DOUBLE)
                          / CAST(count(*) * 100 AS DOUBLE) AS price
                 FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"""
_RISK = "WITH " + _series("s", _STOCK_SRC) + "," + _series("f", _FACTOR_SRC)

ORACLE["bday_fill"] = _RISK + """
SELECT instrument, date, price FROM s_filled"""

ORACLE["price_folder"] = ORACLE["bday_fill"]

ORACLE["horizon_returns"] = _RISK + """
SELECT instrument, date, round(ret, 8) AS ret FROM s_ret"""

_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
ORACLE["factor_matrix"] = _RISK + """
SELECT date, """ + ", ".join(
    f"max(CASE WHEN instrument = '{x}' THEN round(ret, 8) END) AS \"{x}\"" for x in _SEGMENTS) + """
FROM f_ret GROUP BY date"""

ORACLE["factor_cov"] = _RISK + """
SELECT a.instrument AS factor_a, b.instrument AS factor_b, round(covar_samp(a.ret, b.ret), 10) AS cov
FROM f_ret a JOIN f_ret b USING (date) GROUP BY 1, 2"""

ORACLE["factor_features"] = _RISK + """,
nf AS (SELECT count(DISTINCT instrument) AS n FROM f_ret),
full_dates AS (SELECT date FROM f_ret GROUP BY date HAVING count(*) = (SELECT n FROM nf)),
ranked AS (SELECT f.date, f.ret,
                  row_number() OVER (PARTITION BY f.date ORDER BY f.instrument) - 1 AS j
           FROM f_ret f JOIN full_dates USING (date))
SELECT date, CAST(j AS INTEGER) AS idx, round(sign(ret) * ret * ret, 8) AS value FROM ranked
UNION ALL
SELECT date, CAST(j + (SELECT n FROM nf) AS INTEGER), round(sign(ret) * sqrt(abs(ret)), 8) FROM ranked
UNION ALL
SELECT date, CAST(j + 2 * (SELECT n FROM nf) AS INTEGER), round(ret, 8) FROM ranked"""

ORACLE["factor_beta"] = _RISK + """
SELECT s.instrument, f.instrument AS factor,
       round(regr_slope(s.ret, f.ret), 6) AS beta, round(regr_intercept(s.ret, f.ret), 6) AS alpha
FROM s_ret s JOIN f_ret f USING (date) GROUP BY 1, 2"""

ORACLE["var_cvar"] = _RISK + """,
r AS (SELECT ret, row_number() OVER (ORDER BY ret) AS rn FROM s_ret),
k AS (SELECT greatest(floor(count(*) / 20.0), 1) AS k FROM s_ret)
SELECT round(max(ret) FILTER (WHERE rn = k), 8) AS var, round(avg(ret) FILTER (WHERE rn <= k), 8) AS cvar
FROM r, k"""


def _poisson_sql(u: str) -> str:
    from quarry.operators.risk import POISSON1_CDF
    arms = " ".join(f"WHEN {u} <= {c!r} THEN {j}" for j, c in enumerate(POISSON1_CDF))
    return f"CASE {arms} ELSE 8 END"


ORACLE["bootstrap_ci"] = _RISK + f""",
hk AS (SELECT instrument || '|' || CAST(date AS VARCHAR) AS key, ret FROM s_ret),
b AS (SELECT g, ret,
             (CAST('0x' || substr(md5(key || '|' || CAST(g AS VARCHAR) || '|7'), 1, 8) AS BIGINT) + 0.5)
               / 4294967296.0 AS u
      FROM hk, range(100) t(g)),
bw AS (SELECT g, ret, {_poisson_sql('u')} AS w FROM b),
bw2 AS (SELECT * FROM bw WHERE w > 0),
kk AS (SELECT g, greatest(floor(sum(w) / 20.0), 1) AS k FROM bw2 GROUP BY g),
cum AS (SELECT g, ret, w, sum(w) OVER (PARTITION BY g ORDER BY ret ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
               - w AS before FROM bw2),
st AS (SELECT c.g, min(c.ret) FILTER (WHERE c.before + c.w >= k.k) AS var,
              sum(c.ret * least(c.w, k.k - c.before)) FILTER (WHERE c.before < k.k) / k.k AS cvar
       FROM cum c JOIN kk k USING (g) GROUP BY c.g, k.k),
rv AS (SELECT var AS v, row_number() OVER (ORDER BY var, g) - 1 AS i FROM st),
rc AS (SELECT cvar AS v, row_number() OVER (ORDER BY cvar, g) - 1 AS i FROM st)
SELECT 'var' AS stat, round(max(v) FILTER (WHERE i = 1), 8) AS lower, round(max(v) FILTER (WHERE i = 98), 8) AS upper
FROM rv
UNION ALL
SELECT 'cvar', round(max(v) FILTER (WHERE i = 1), 8), round(max(v) FILTER (WHERE i = 98), 8) FROM rc"""

ORACLE["return_kde"] = _RISK + """,
mm AS (SELECT min(ret) AS lo, max(ret) AS hi FROM s_ret),
g AS (SELECT CAST(i AS INTEGER) AS i, lo + i * (hi - lo) / 100.0 AS x FROM mm, range(100) t(i))
SELECT g.i, round(g.x, 8) AS x,
       round(avg(exp(-0.5 * (g.x - s.ret) * (g.x - s.ret)) / sqrt(2 * pi())), 8) AS density
FROM g, s_ret s GROUP BY g.i, g.x"""


# -------------------------------------------------------------- recommend
_RATINGS = """
plays AS (SELECT o_custkey AS "user", l_partkey AS item, count(*) AS count
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
good AS (SELECT p_name, p_brand, min(p_partkey) AS good FROM part GROUP BY 1, 2),
alias AS (SELECT p.p_partkey AS bad, g.good FROM part p JOIN good g USING (p_name, p_brand)
          WHERE p.p_partkey <> g.good),
ratings AS (SELECT "user", coalesce(a.good, item) AS item, CAST(sum(count) AS BIGINT) AS count
            FROM plays LEFT JOIN alias a ON a.bad = plays.item GROUP BY 1, 2),
r AS (SELECT *, CAST('0x' || substr(md5(CAST("user" AS VARCHAR) || '|' || CAST(item AS VARCHAR) || '|fold'), 1, 8)
                     AS BIGINT) % 10 AS fold_of FROM ratings),
items AS (SELECT item, row_number() OVER (ORDER BY item) - 1 AS idx FROM (SELECT DISTINCT item FROM r) x),
ni AS (SELECT count(*) AS n FROM items)
"""


def _auc_sql(folds: bool) -> str:
    if folds:
        fx = "CROSS JOIN range(10) f(fold)"
        g, gsel, key = '"fold", "user"', 'f.fold AS "fold", r."user"', "CAST(fold AS VARCHAR) || '|' || "
    else:
        fx = ""
        g, gsel, key = '"user"', 'CAST(0 AS BIGINT) AS "fold", r."user"', ""
    return f"""
WITH {_RATINGS},
rf AS (SELECT {gsel}, r.item, r.count, r.fold_of FROM r {fx}),
cv AS (SELECT * FROM rf WHERE fold_of = "fold"),
train AS (SELECT * FROM rf WHERE fold_of <> "fold"),
pos AS (SELECT DISTINCT "fold", "user", item FROM cv),
npos AS (SELECT "fold", "user", count(*) AS n_pos FROM pos GROUP BY 1, 2),
draws AS (SELECT p."fold", p."user", p.n_pos, t.idx AS j,
                 CAST('0x' || substr(md5({key.replace('fold', 'p.fold')}CAST(p."user" AS VARCHAR) || '|' || CAST(t.idx AS VARCHAR) || '|42'), 1, 8)
                      AS BIGINT) % (SELECT n FROM ni) AS didx
          FROM npos p CROSS JOIN items t),
cand AS (SELECT d."fold", d."user", d.n_pos, d.j, i.item FROM draws d JOIN items i ON i.idx = d.didx
         WHERE NOT EXISTS (SELECT 1 FROM pos q WHERE q."fold" = d."fold" AND q."user" = d."user" AND q.item = i.item)),
neg AS (SELECT "fold", "user", item FROM (
          SELECT *, row_number() OVER (PARTITION BY "fold", "user" ORDER BY j) AS rn FROM cand) x
        WHERE rn <= n_pos),
pop AS (SELECT "fold", item, CAST(sum(count) AS DOUBLE) AS score FROM train GROUP BY 1, 2),
ps AS (SELECT c."fold", c."user", coalesce(p.score, 0.0) AS score FROM cv c LEFT JOIN pop p USING ("fold", item)),
ns AS (SELECT n."fold", n."user", coalesce(p.score, 0.0) AS score FROM neg n LEFT JOIN pop p USING ("fold", item)),
auc AS (SELECT ps."fold", ps."user", avg(CASE WHEN ps.score > ns.score THEN 1.0 ELSE 0.0 END) AS auc
        FROM ps JOIN ns USING ("fold", "user") GROUP BY 1, 2)
"""


ORACLE["artist_parse"] = """
SELECT p_partkey AS id, trim(p_name) AS name FROM part WHERE p_size NOT IN (2, 3)
"""

ORACLE["resolve_alias"] = f"""
WITH {_RATINGS}
SELECT "user", item, count FROM ratings
"""

ORACLE["popularity"] = f"""
WITH {_RATINGS}
SELECT item, CAST(sum(count) AS BIGINT) AS pop FROM ratings GROUP BY item
"""

ORACLE["user_auc"] = _auc_sql(False) + """
SELECT "user", round(auc, 4) AS auc FROM auc
"""

ORACLE["cv_auc"] = _auc_sql(True) + """
SELECT CAST("fold" AS INTEGER) AS "fold", round(avg(auc), 6) AS mean_auc FROM auc GROUP BY 1
"""


# ------------------------------------------------------------------ graph
_GRAPH = """WITH RECURSIVE
v AS (SELECT s_suppkey AS id FROM supplier),
h AS (SELECT a.l_suppkey AS src, b.l_suppkey AS dst FROM lineitem a JOIN lineitem b
      ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1),
e AS (SELECT src, dst, count(*) AS cnt FROM h WHERE src <> dst GROUP BY 1, 2),
ue AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e)"""


ORACLE["components"] = _GRAPH + """,
reach(a, b) AS (SELECT id, id FROM v UNION SELECT r.a, ue.dst FROM reach r JOIN ue ON ue.src = r.b)
SELECT a AS id, min(b) AS component FROM reach GROUP BY a"""

ORACLE["component_sizes"] = _GRAPH + """,
reach(a, b) AS (SELECT id, id FROM v UNION SELECT r.a, ue.dst FROM reach r JOIN ue ON ue.src = r.b),
c AS (SELECT a AS id, min(b) AS component FROM reach GROUP BY a)
SELECT component, count(*) AS cnt FROM c GROUP BY component"""

ORACLE["scc"] = _GRAPH + """,
reach(a, b) AS (SELECT id, id FROM v UNION SELECT r.a, e.dst FROM reach r JOIN e ON e.src = r.b)
SELECT r.a AS id, min(r.b) AS component FROM reach r JOIN reach q ON q.a = r.b AND q.b = r.a GROUP BY r.a"""

ORACLE["degrees"] = _GRAPH + """,
ends AS (SELECT src AS id FROM e UNION ALL SELECT dst FROM e)
SELECT id, count(*) AS degree FROM ends JOIN v USING (id) GROUP BY id"""

_TRI = """,
tris AS (SELECT a.src AS x, a.dst AS y, b.dst AS z FROM ue a JOIN ue b ON b.src = a.dst
      JOIN ue c ON c.src = a.src AND c.dst = b.dst WHERE a.src < a.dst AND a.dst < b.dst),
per AS (SELECT id, count(*) AS n FROM (SELECT x AS id FROM tris UNION ALL SELECT y FROM tris UNION ALL SELECT z FROM tris) q
        GROUP BY id),
tri AS (SELECT v.id, coalesce(per.n, 0) AS triangles FROM v LEFT JOIN per USING (id)),
deg AS (SELECT src AS id, count(*) AS degree FROM ue GROUP BY src),
cc AS (SELECT tri.id, tri.triangles, coalesce(deg.degree, 0) AS degree,
              CASE WHEN coalesce(deg.degree, 0) >= 2 THEN tri.triangles / (deg.degree * (deg.degree - 1) / 2.0) END
              AS coef
       FROM tri LEFT JOIN deg USING (id))"""

ORACLE["triangles"] = _GRAPH + _TRI + """
SELECT id, triangles FROM tri"""

ORACLE["clustering_coef"] = _GRAPH + _TRI + """
SELECT id, triangles, degree, round(coef, 4) AS coef FROM cc"""

ORACLE["clustering_mean"] = _GRAPH + _TRI + """
SELECT round(avg(coef), 4) AS mean_coef FROM cc"""

ORACLE["landmark_paths"] = _GRAPH + """,
lm AS (SELECT id FROM v
       QUALIFY (CAST('0x' || substr(md5(CAST(id AS VARCHAR) || '|1'), 1, 8) AS BIGINT) + 0.5) / 4294967296.0 < 0.05
            OR row_number() OVER (ORDER BY substr(md5(CAST(id AS VARCHAR) || '|1'), 1, 8), id) <= 64),
bfs(landmark, id, dist) AS (
  SELECT id, id, 0 FROM lm
  UNION SELECT b.landmark, e.dst, b.dist + 1 FROM bfs b JOIN e ON e.src = b.id
        WHERE b.dist < (SELECT count(*) FROM v))
SELECT id, landmark, CAST(min(dist) AS INTEGER) AS dist FROM bfs GROUP BY id, landmark"""


def _pagerank_sql(iters: int = 5, alpha: float = 0.15) -> str:
    parts = [_GRAPH + """,
n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM v),
od AS (SELECT src, count(*) AS outdeg FROM e GROUP BY src),
r0 AS (SELECT id, 1.0 / (SELECT n FROM n) AS rank FROM v)"""]
    for i in range(1, iters + 1):
        parts.append(f""",
r{i} AS (SELECT v.id, {alpha} / (SELECT n FROM n) + {1 - alpha} * coalesce(s.s, 0.0) AS rank
        FROM v LEFT JOIN (SELECT e.dst AS id, sum(r.rank / od.outdeg) AS s
                          FROM e JOIN od USING (src) JOIN r{i - 1} r ON r.id = e.src GROUP BY e.dst) s
        USING (id))""")
    parts.append(f"\nSELECT id, round(rank, 10) AS rank FROM r{iters}")
    return "".join(parts)


ORACLE["pagerank5"] = _pagerank_sql()


# ------------------------------------------------------------------- text
# Spark's default English stop-word list (StopWordsRemover).
STOP_WORDS_EN = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom this "
    "that these those am is are was were be been being have has had having do does did doing a an "
    "the and but if or because as until while of at by for with about against between into through "
    "during before after above below to from up down in out on off over under again further then "
    "once here there when where why how all any both each few more most other some such no nor not "
    "only own same so than too very s t can will just don should now i'll you'll he'll she'll we'll "
    "they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've "
    "you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't "
    "wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's "
    "there's what's when's where's who's why's would").split()

_SW = ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS_EN)
_TEXT = f"""
docs AS (SELECT doc_id, text FROM documents),
toks AS (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '\\p{{L}}+')) AS term FROM docs),
tf AS (SELECT doc_id, term, count(*) AS tf FROM toks WHERE term NOT IN ({_SW}) GROUP BY 1, 2),
vocab AS (SELECT term FROM tf GROUP BY term ORDER BY sum(tf) DESC, term ASC LIMIT 20),
t AS (SELECT tf.* FROM tf JOIN vocab USING (term)),
dfq AS (SELECT term, count(*) AS df FROM t GROUP BY term),
ti AS (SELECT t.doc_id, t.term, t.tf,
              ln(((SELECT count(*) FROM docs) + 1.0) / (dfq.df + 1.0)) AS idf
       FROM t JOIN dfq USING (term)),
tw AS (SELECT *, tf * idf AS tfidf FROM ti)
"""

ORACLE["tokens"] = f"WITH {_TEXT} SELECT doc_id, term, tf FROM tf"

_FORMS = ", ".join(str(f) for f in lemmas.FORMS)
_ENDINGS = ", ".join(str(e) for e in lemmas.ENDINGS)
ORACLE["lemmas"] = f"""WITH {_TEXT},
forms(lang, form, lemma) AS (VALUES {_FORMS}),
endings(lang, suffix, ending) AS (VALUES {_ENDINGS}),
words AS (SELECT DISTINCT coalesce(lang, '') AS lang, term FROM tf JOIN documents USING (doc_id)),
ruled AS (SELECT w.lang, w.term, arg_max(left(w.term, length(w.term) - length(suffix)) || ending, length(suffix)) AS lemma
          FROM words w JOIN endings e ON e.lang = w.lang AND suffix(w.term, e.suffix)
          WHERE length(w.term) - length(e.suffix) >= {lemmas.STEM} GROUP BY 1, 2),
found AS (SELECT w.lang, w.term, coalesce(f.lemma, r.lemma, w.term) AS lemma FROM words w
          LEFT JOIN forms f ON f.lang = w.lang AND f.form = w.term LEFT JOIN ruled r ON r.lang = w.lang AND r.term = w.term)
SELECT tf.doc_id, f.lemma, CAST(sum(tf.tf) AS BIGINT) AS tf FROM tf JOIN documents d USING (doc_id)
JOIN found f ON f.lang = coalesce(d.lang, '') AND f.term = tf.term GROUP BY 1, 2"""

ORACLE["tfidf"] = f"""WITH {_TEXT}
SELECT doc_id, term, tf, round(idf, 6) AS idf, round(tfidf, 6) AS tfidf FROM tw"""

ORACLE["doc_cosine"] = f"""WITH {_TEXT},
nrm AS (SELECT doc_id, sqrt(sum(tfidf * tfidf)) AS norm FROM tw GROUP BY doc_id),
u AS (SELECT tw.doc_id, tw.term, CASE WHEN norm > 0 THEN tfidf / norm ELSE 0 END AS unit
      FROM tw JOIN nrm USING (doc_id)),
q AS (SELECT term, unit AS q FROM u WHERE doc_id = (SELECT min(doc_id) FROM docs)),
c AS (SELECT u.doc_id, sum(u.unit * q.q) AS cosine FROM u JOIN q USING (term) GROUP BY u.doc_id)
SELECT doc_id, round(cosine, 6) AS cosine FROM c ORDER BY round(cosine, 9) DESC, doc_id ASC LIMIT 10"""


# --------------------------------------------------------------- classify
_COVER = """
cust AS (SELECT c_mktsegment, c_nationkey, row_number() OVER (ORDER BY c_custkey) - 1 AS idx FROM customer),
cov AS (SELECT e.vec_id, e.label AS label0, c.c_mktsegment, c.c_nationkey,
               CASE WHEN (CAST('0x' || substr(md5(CAST(e.vec_id AS VARCHAR) || '|split'), 1, 8) AS BIGINT)) % 10 < 8
                    THEN 'train'
                    WHEN (CAST('0x' || substr(md5(CAST(e.vec_id AS VARCHAR) || '|split'), 1, 8) AS BIGINT)) % 10 = 8
                    THEN 'cv' ELSE 'test' END AS split
        FROM embeddings e LEFT JOIN cust c ON c.idx = e.vec_id % (SELECT count(*) FROM customer))
"""

ORACLE["onehot_decode"] = f"""WITH {_COVER}
SELECT vec_id, label0 AS label,
       CAST(list_position(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'], c_mktsegment) - 1
            AS INTEGER) AS wilderness,
       CAST(c_nationkey AS INTEGER) AS soil
FROM cov"""

ORACLE["class_priors"] = f"""WITH {_COVER}
SELECT label0 AS label, round(count(*) / (SELECT count(*) FROM cov)::DOUBLE, 6) AS prior
FROM cov GROUP BY label0"""

ORACLE["random_baseline"] = f"""WITH {_COVER},
tr AS (SELECT label0, count(*) / (SELECT count(*) FROM cov WHERE split = 'train')::DOUBLE AS p
       FROM cov WHERE split = 'train' GROUP BY 1),
cv AS (SELECT label0, count(*) / (SELECT count(*) FROM cov WHERE split = 'cv')::DOUBLE AS p
       FROM cov WHERE split = 'cv' GROUP BY 1)
SELECT round(sum(tr.p * cv.p), 6) AS accuracy FROM tr JOIN cv USING (label0)"""


# ------------------------------------------------------------ general ops
ORACLE["csv_roundtrip"] = "SELECT * FROM part"

ORACLE["materialized_components"] = ORACLE["components"]

ORACLE["view_sql"] = """
SELECT p_type, count(*) AS cnt FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type"""

ORACLE["flatten"] = """
SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part"""

ORACLE["sample_hash"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
WHERE (CAST('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) || '|'
       || CAST(l_partkey AS VARCHAR) || '|1'), 1, 8) AS BIGINT) + 0.5) / 4294967296.0 < 0.05"""

ORACLE["sample_stats"] = """
WITH x AS (SELECT l_returnflag, CASE WHEN l_discount > 0 THEN l_extendedprice * (1 - l_discount) END AS v
           FROM lineitem),
s AS (SELECT l_returnflag, count(v) AS cnt, count(*) - count(v) AS missing, avg(v) AS mean,
             stddev_pop(v) AS stdev, min(v) AS mn, max(v) AS mx FROM x GROUP BY l_returnflag)
SELECT l_returnflag, cnt, missing, round(mean, 4) AS mean, round(stdev, 4) AS stdev,
       round(mn, 4) AS min, round(mx, 4) AS max,
       CAST(ceil(sqrt(abs(mx - mn))) AS BIGINT) AS ceil_sqrt_range,
       round(pow(mean / 1000.0, 2), 4) AS mean_k_sq
FROM s"""

ORACLE["top_k"] = """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey ASC LIMIT 10"""

ORACLE["sorted_summary"] = """
SELECT c_nationkey, count(*) AS cnt, round(count(*) / (SELECT count(*) FROM customer)::DOUBLE, 6) AS share
FROM customer GROUP BY c_nationkey"""

ORACLE["union_distinct"] = """
SELECT l_suppkey AS suppkey FROM lineitem UNION SELECT s_suppkey FROM supplier WHERE s_acctbal < 0"""

ORACLE["partition_pairs"] = _trips_with("""
SELECT license, trip_id, lead(trip_id) OVER (PARTITION BY license ORDER BY pickup_datetime, trip_id)
       AS next_trip_id
FROM done QUALIFY next_trip_id IS NOT NULL""", zoned=True)

ORACLE["landmark_maps"] = _GRAPH + """,
lm AS (SELECT id FROM v
       QUALIFY (CAST('0x' || substr(md5(CAST(id AS VARCHAR) || '|1'), 1, 8) AS BIGINT) + 0.5) / 4294967296.0 < 0.05
            OR row_number() OVER (ORDER BY substr(md5(CAST(id AS VARCHAR) || '|1'), 1, 8), id) <= 64),
bfs(landmark, id, dist) AS (
  SELECT id, id, 0 FROM lm
  UNION SELECT b.landmark, e.dst, b.dist + 1 FROM bfs b JOIN e ON e.src = b.id
        WHERE b.dist < (SELECT count(*) FROM v)),
best AS (SELECT id, landmark, min(dist) AS dist FROM bfs GROUP BY id, landmark),
agg AS (SELECT id, count(*) AS n, string_agg(CAST(landmark AS VARCHAR) || ':' || CAST(dist AS VARCHAR), ','
                                              ORDER BY landmark) AS hops
        FROM best GROUP BY id)
SELECT v.id, CAST(coalesce(agg.n, 0) AS INTEGER) AS n_landmarks, coalesce(agg.hops, '') AS hops
FROM v LEFT JOIN agg USING (id)"""

ORACLE["xml_wholetext_topics"] = """
SELECT p.p_name AS topic, count(*) AS cnt
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey WHERE l.l_quantity >= 25 GROUP BY p.p_name
"""

_PRUNED = ORACLE["cooccurrence_chisq"].replace("WITH ", "WITH RECURSIVE ", 1).rsplit("SELECT topic_a, topic_b,", 1)[0] + """,
ed AS (SELECT least(substr(md5(topic_a), 1, 8), substr(md5(topic_b), 1, 8)) AS src,
              greatest(substr(md5(topic_a), 1, 8), substr(md5(topic_b), 1, 8)) AS dst FROM c WHERE chi > 3.84),
vx AS (SELECT DISTINCT substr(md5(topic), 1, 8) AS id, topic FROM items),
ue AS (SELECT src, dst FROM ed UNION SELECT dst, src FROM ed)"""

ORACLE["interesting_components"] = _PRUNED + """,
reach(a, b) AS (SELECT id, id FROM vx UNION SELECT r.a, ue.dst FROM reach r JOIN ue ON ue.src = r.b)
SELECT vx.id, vx.topic, min(r.b) AS component FROM reach r JOIN vx ON vx.id = r.a GROUP BY vx.id, vx.topic"""

ORACLE["interesting_degrees"] = _PRUNED + """,
ends AS (SELECT src AS id FROM ed UNION ALL SELECT dst FROM ed)
SELECT vx.id, vx.topic, count(*) AS degree FROM ends JOIN vx USING (id) GROUP BY vx.id, vx.topic"""

_PRUNED_V = _PRUNED + """,
v AS (SELECT DISTINCT id FROM vx)"""

ORACLE["interesting_triangles"] = _PRUNED_V + _TRI + """
SELECT id, triangles FROM tri"""

ORACLE["interesting_clustering"] = _PRUNED_V + _TRI + """
SELECT id, triangles, degree, round(coef, 4) AS coef FROM cc"""

ORACLE["interesting_landmarks"] = _PRUNED_V + """,
lm AS (SELECT id FROM v WHERE (CAST('0x' || substr(md5(id || '|1'), 1, 8) AS BIGINT) + 0.5) / 4294967296.0 < 0.05),
bfs(landmark, id, dist) AS (
  SELECT id, id, 0 FROM lm
  UNION SELECT b.landmark, ue.dst, b.dist + 1 FROM bfs b JOIN ue ON ue.src = b.id
        WHERE b.dist < 64)
SELECT id, landmark, CAST(min(dist) AS INTEGER) AS dist FROM bfs GROUP BY id, landmark"""
