"""Registered queries: one Spark implementation and (where SQL can say it)
one DuckDB oracle per operator of the inventory.

Every query reads the driver's parquet tables (through the derived views of
``sources.tables``) in full.  Floating results are rounded to 6 decimals in
both engines; oracle factors are the deterministic rank-2 factors.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.vectors import dot
from .operators import objective, ratings as rt, recommend as rc, regression as rg
from .sources import tables as tb

LAM = 0.01
R6 = 6
#: Rating lines in a part file that Spark writes in the order of arrival.
LINES_PER_FILE = 1_000_000

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(c):
    return F.round(c, R6)


# ------------------------------------------------------------------ SQL pieces
R_ORD_SQL = """r AS (
  SELECT CAST(o_custkey AS BIGINT) AS "user", CAST(l_partkey AS BIGINT) AS item,
         CAST(1 + CAST(SUM(l_quantity) AS INT) % 5 AS DOUBLE) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""

R_EV_SQL = """r AS (
  SELECT CAST(user_id AS BIGINT) AS "user", CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS item,
         least(5.0e0, greatest(1.0e0, avg(value) / 5.0e0)) AS rating
  FROM events GROUP BY 1, 2)"""

DET_SQL = """uf AS (
  SELECT id, ((id*31+17) % 97) / 97.0e0 + 0.1e0 AS f0, ((id*53+29) % 89) / 89.0e0 + 0.1e0 AS f1
  FROM (SELECT DISTINCT "user" AS id FROM r)),
vf AS (
  SELECT id, ((id*37+19) % 83) / 83.0e0 + 0.1e0 AS f0, ((id*41+23) % 79) / 79.0e0 + 0.1e0 AS f1
  FROM (SELECT DISTINCT item AS id FROM r))"""

NR_SQL = "nr AS (SELECT CAST(COUNT(*) AS DOUBLE) AS n FROM r)"


def with_sql(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _r_ord(spark, d):
    return tb.ratings_from_orders(spark, d)


def _r_ev(spark, d):
    return tb.ratings_from_events(spark, d)


def _r_ord_once(spark, d):
    """``r_ord`` derived once and written, for queries that read it several times (``drop_cut`` deletes it)."""
    from .session import cut
    return cut(_r_ord(spark, d))


def _det_once(r):
    """The deterministic factors, written: each pass over them would otherwise read the ratings again."""
    from .session import cut
    return [cut(f) for f in tb.det_model(r)]


def drop_all(*tables):
    from .session import drop_cut
    for t in tables:
        drop_cut(t)


def _flat2(df: DataFrame, col: str = "features", prefix: str = "f") -> list:
    return [r6(F.col(col).getItem(j)).alias(f"{prefix}{j}") for j in range(2)]


# ------------------------------------------------------------------ A1/A2 dims
@register("a1_dims", with_sql(R_ORD_SQL) + """
SELECT MAX("user") + 1 AS n_users, MAX(item) + 1 AS n_items, COUNT(*) AS n_ratings FROM r""")
def q_a1_dims(spark, d):
    return rt.dims_frame(_r_ord(spark, d))


# ------------------------------------------------------------------ A3 rated set
@register("a3_rated_items", with_sql(R_ORD_SQL) + """
SELECT "user", CAST(item // 256 AS BIGINT) AS chunk, COUNT(*) AS n_items,
       string_agg(CAST(item AS VARCHAR), ',' ORDER BY item) AS items
FROM (SELECT DISTINCT "user", item FROM r) GROUP BY "user", item // 256""")
def q_a3_rated_items(spark, d):
    """Sorted rated items in id chunks of 256 (several chunks per user)."""
    s = rt.rated_items(_r_ord(spark, d), chunk=256)
    return s.select("user", "chunk", F.size("items").cast("long").alias("n_items"),
                    F.array_join(F.col("items").cast("array<string>"), ",").alias("items"))


# ------------------------------------------------------------------ Q3 dedupe
@register("q3_dedupe", """
WITH l AS (
  SELECT CAST(o_custkey AS BIGINT) AS "user", CAST(l_partkey AS BIGINT) AS item,
         CAST(1 + CAST(l_quantity AS INT) % 5 AS DOUBLE) AS rating, l_orderkey * 8 + l_linenumber AS ord
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT "user", item, arg_max(rating, ord * 8 + rating) AS rating, COUNT(*) AS n_lines FROM l GROUP BY 1, 2""")
def q_q3_dedupe(spark, d):
    return rt.dedupe_ratings(tb.rating_lines_from_orders(spark, d), with_count=True)


# ------------------------------------------------------------------ J1/R1 residuals
@register("r1_residuals", with_sql(R_ORD_SQL, DET_SQL) + """
SELECT r."user", r.item, r.rating,
       round(uf.f0*vf.f0 + uf.f1*vf.f1, 6) AS pred,
       round(r.rating - (uf.f0*vf.f0 + uf.f1*vf.f1), 6) AS resid
FROM r JOIN uf ON uf.id = r."user" JOIN vf ON vf.id = r.item""")
def q_r1_residuals(spark, d):
    r = _r_ord(spark, d)
    uf, vf = tb.det_model(r)
    res = rt.residuals(r, uf, vf, 2)
    return res.select("user", "item", "rating", r6("pred").alias("pred"), r6("resid").alias("resid"))


# ------------------------------------------------------------------ J5 pad factors
# users with some part bought at least 60 times: few, and user 0 is not among them
HEAVY_SQL = """present AS (
  SELECT DISTINCT CAST(o_custkey AS BIGINT) AS id FROM (
    SELECT o_custkey, l_partkey, SUM(l_quantity) AS q FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)
  WHERE q >= 60),
ids AS (SELECT CAST(range AS BIGINT) AS id FROM range((SELECT MAX(o_custkey) + 1 FROM lineitem JOIN orders ON l_orderkey = o_orderkey)))"""


def _heavy_factors(spark, d):
    li, od = tb.table(spark, d, "lineitem"), tb.table(spark, d, "orders")
    q = li.join(od, li.l_orderkey == od.o_orderkey).groupBy("o_custkey", "l_partkey").agg(F.sum("l_quantity").alias("q"))
    return tb.det_factors(q.filter("q >= 60"), "o_custkey", "user"), rt.dims(_r_ord(spark, d)).n_users


@register("j5_pad_factors", with_sql(HEAVY_SQL) + """
SELECT ids.id,
       round(CASE WHEN p.id IS NULL THEN 0.0e0 ELSE ((ids.id*31+17) % 97) / 97.0e0 + 0.1e0 END, 6) AS f0,
       round(CASE WHEN p.id IS NULL THEN 0.0e0 ELSE ((ids.id*53+29) % 89) / 89.0e0 + 0.1e0 END, 6) AS f1
FROM ids LEFT JOIN present p ON p.id = ids.id""")
def q_j5_pad_factors(spark, d):
    """Factors of the heavy buyers padded to all customers (most ids, 0 among them, get the zero vector)."""
    f, n = _heavy_factors(spark, d)
    return rt.pad_factors(f, n, 2).select("id", *_flat2(None))


@register("u2_missing_ids", with_sql(HEAVY_SQL) + "SELECT id FROM ids WHERE id NOT IN (SELECT id FROM present)")
def q_u2_missing_ids(spark, d):
    return rt.missing_ids(*_heavy_factors(spark, d))


@register("p3_restrict", with_sql(R_ORD_SQL) + """,
m AS (SELECT MAX("user") // 3 AS u, MAX(item) // 2 AS i FROM r)
SELECT r.* FROM r, m WHERE r."user" <= m.u AND r.item <= m.i""")
def q_p3_restrict(spark, d):
    """A third of the users, half of the items."""
    r = _r_ord(spark, d)
    n = rt.dims(r)
    return rt.restrict(r, (n.n_users - 1) // 3, (n.n_items - 1) // 2)


# ------------------------------------------------------------------ A5 loss
@register("a5_loss", with_sql(R_ORD_SQL, DET_SQL, NR_SQL) + """,
s AS (SELECT SUM((r.rating - (uf.f0*vf.f0 + uf.f1*vf.f1)) * (r.rating - (uf.f0*vf.f0 + uf.f1*vf.f1))) AS sse
      FROM r JOIN uf ON uf.id = r."user" JOIN vf ON vf.id = r.item),
su AS (SELECT SUM(f0*f0 + f1*f1) AS su FROM uf),
si AS (SELECT SUM(f0*f0 + f1*f1) AS si FROM vf)
SELECT round(sse, 6) AS sse, round(su, 6) AS reg_user, round(si, 6) AS reg_item,
       round(0.5e0 * (sse + 0.01e0 * su + 0.01e0 * si) / n, 6) AS loss
FROM s, su, si, nr""")
def q_a5_loss(spark, d):
    r = _r_ord(spark, d)
    uf, vf = tb.det_model(r)
    n = r.count()
    lf = objective.loss_frame(r, uf, vf, 2, LAM, n)
    return lf.select(*[r6(c).alias(c) for c in ("sse", "reg_user", "reg_item", "loss")])


# ------------------------------------------------------------------ A6 gradient
GRAD_SQL = """,
e AS (SELECT r."user", r.item, (uf.f0*vf.f0 + uf.f1*vf.f1) - r.rating AS delta,
             uf.f0 AS u0, uf.f1 AS u1, vf.f0 AS v0, vf.f1 AS v1
      FROM r JOIN uf ON uf.id = r."user" JOIN vf ON vf.id = r.item),
gu AS (SELECT "user" AS id, SUM(delta*v0) AS g0, SUM(delta*v1) AS g1 FROM e GROUP BY 1),
gi AS (SELECT item AS id, SUM(delta*u0) AS g0, SUM(delta*u1) AS g1 FROM e GROUP BY 1),
du AS (SELECT uf.id, (coalesce(gu.g0, 0.0e0) + 0.01e0*uf.f0) / nr.n AS f0,
              (coalesce(gu.g1, 0.0e0) + 0.01e0*uf.f1) / nr.n AS f1
       FROM uf LEFT JOIN gu ON gu.id = uf.id, nr),
di AS (SELECT vf.id, (coalesce(gi.g0, 0.0e0) + 0.01e0*vf.f0) / nr.n AS f0,
              (coalesce(gi.g1, 0.0e0) + 0.01e0*vf.f1) / nr.n AS f1
       FROM vf LEFT JOIN gi ON gi.id = vf.id, nr)"""


@register("a6_gradient", with_sql(R_ORD_SQL, DET_SQL, "nr AS (SELECT 1.0e0 AS n)") + GRAD_SQL + """
SELECT 'user' AS side, id, round(f0, 6) AS g0, round(f1, 6) AS g1 FROM du
UNION ALL
SELECT 'item' AS side, id, round(f0, 6) AS g0, round(f1, 6) AS g1 FROM di""")
def q_a6_gradient(spark, d):
    """Normaliser 1, so that the λ term (about 0.005) stands well above the rounding."""
    r = _r_ord(spark, d)
    uf, vf = tb.det_model(r)
    du, di = objective.gradient(r, uf, vf, 2, LAM, 1.0)
    return (du.select(F.lit("user").alias("side"), "id", *_flat2(None, prefix="g"))
            .unionByName(di.select(F.lit("item").alias("side"), "id", *_flat2(None, prefix="g"))))


# ------------------------------------------------------------------ A7 gram
@register("a7_gram", with_sql(R_ORD_SQL, DET_SQL) + """
SELECT r.item, round(SUM(uf.f0*uf.f0), 6) AS g_0_0, round(SUM(uf.f0*uf.f1), 6) AS g_0_1,
       round(SUM(uf.f1*uf.f1), 6) AS g_1_1, round(SUM(uf.f0*r.rating), 6) AS b_0,
       round(SUM(uf.f1*r.rating), 6) AS b_1, COUNT(*) AS n
FROM r JOIN uf ON uf.id = r."user" GROUP BY r.item""")
def q_a7_gram(spark, d):
    r = _r_ord(spark, d)
    uf, _ = tb.det_model(r)
    j = r.join(uf.select(F.col("id").alias("user"), F.col("features").alias("x")), "user")
    g = rg.gram(j, ["item"], "x", "rating", k=2)
    return g.select("item", *[r6(c).alias(c) for c in ("g_0_0", "g_0_1", "g_1_1", "b_0", "b_1")], "n")


# ------------------------------------------------------------------ M2 half-step
HALF_ITEM_SQL = """,
g AS (SELECT r.item AS id, SUM(uf.f0*uf.f0) + 0.01e0 AS a, SUM(uf.f0*uf.f1) AS b, SUM(uf.f1*uf.f1) + 0.01e0 AS c,
             SUM(uf.f0*r.rating) AS y0, SUM(uf.f1*r.rating) AS y1
      FROM r JOIN uf ON uf.id = r."user" GROUP BY r.item)"""


@register("m2_half_step", with_sql(R_ORD_SQL, DET_SQL) + HALF_ITEM_SQL + """
SELECT id, round((c*y0 - b*y1) / (a*c - b*b), 6) AS f0, round((a*y1 - b*y0) / (a*c - b*b), 6) AS f1 FROM g""")
def q_m2_half_step(spark, d):
    r = _r_ord_once(spark, d)
    uf, _ = _det_once(r)
    f = rg.als_half_step(r, uf, "user", "item", 2, LAM)
    return f.select("id", *_flat2(None))


# ------------------------------------------------------------------ R3 recommend
@register("r3_recommend", with_sql(R_ORD_SQL, DET_SQL) + """,
lo AS (SELECT MIN("user") AS u FROM r),
rated AS (SELECT "user", item FROM r UNION SELECT lo.u, vf.id FROM lo, vf),
c AS (SELECT uf.id AS "user", vf.id AS item, uf.f0*vf.f0 + uf.f1*vf.f1 AS score
      FROM uf, vf WHERE NOT EXISTS (SELECT 1 FROM rated WHERE rated."user" = uf.id AND rated.item = vf.id)),
t AS (SELECT "user", item, score, row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS position
      FROM c QUALIFY position <= 20),
req AS (SELECT c_nationkey AS req_pos, c_custkey AS "user" FROM customer
        UNION ALL SELECT c_nationkey, c_custkey * 1000 FROM customer)
SELECT req.req_pos, t."user", CAST(t.position AS INT) AS position, t.item, round(t.score, 6) AS score,
       coalesce(p.p_name, '') AS name
FROM req JOIN t ON t."user" = req."user" LEFT JOIN (SELECT * FROM part WHERE p_size >= 10) p ON p.p_partkey = t.item""")
def q_r3_recommend(spark, d):
    """All customers as requests, many under one key (their nation), some ids unknown and some repeated (custkey·1000);
    the first customer has rated every part; parts smaller than 10 have no title."""
    r = _r_ord_once(spark, d)
    uf, vf = _det_once(r)
    c = tb.table(spark, d, "customer")
    requests = c.select(F.col("c_nationkey").alias("req_pos"), F.col("c_custkey").alias("user")).union(
        c.select("c_nationkey", F.col("c_custkey") * 1000))
    every = vf.select(F.lit(r.agg(F.min("user")).first()[0]).alias("user"), F.col("id").alias("item"))
    items = tb.table(spark, d, "part").filter("p_size >= 10").select(F.col("p_partkey").alias("item"), F.col("p_name").alias("name"))
    recs = rc.recommend(uf, vf, r.select("user", "item").union(every), requests, k=20, items=items)
    return recs.select("req_pos", "user", "position", "item", r6("score").alias("score"), "name")


# ------------------------------------------------------------------ S2/S3/P4 parsing
@register("s2_parse_ratings", """
SELECT CAST(o_custkey AS BIGINT) AS "user", CAST(l_partkey AS BIGINT) AS item,
       CAST(CAST(l_quantity AS INT) % 5 + 1 AS DOUBLE) AS rating
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber <> 1""")
def q_s2_parse_ratings(spark, d):
    """Rating lines written by Spark from lineitem ⋈ orders (1-based ids):
    line 1 of an order has only two fields and a trailing tab (dropped, Q12),
    line 2 carries a fourth field (ignored)."""
    from .sources.text import parse_ratings
    li = tb.table(spark, d, "lineitem")
    od = tb.table(spark, d, "orders")
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    u, i = F.col("o_custkey") + 1, F.col("l_partkey") + 1
    rating = F.col("l_quantity").cast("int") % 5 + 1
    line = (F.when(F.col("l_linenumber") == 1, F.format_string("%d\t%d\t", u, i))
            .when(F.col("l_linenumber") == 2, F.format_string("%d\t%d\t%d\t%d", u, i, rating, F.col("l_orderkey")))
            .otherwise(F.format_string("%d %d %d", u, i, rating)))
    return parse_ratings(j.select(line.alias("value")))


@register("s2_files_to_cells", """
WITH l AS (
  SELECT CAST(o_custkey AS BIGINT) AS "user", CAST(l_partkey AS BIGINT) AS item,
         CAST(CAST(l_quantity AS INT) % 5 + 1 AS DOUBLE) AS rating, l_orderkey * 8 + l_linenumber AS ord
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT "user", item, arg_max(rating, ord * 8 + rating) AS rating FROM l GROUP BY 1, 2""")
def q_s2_files_to_cells(spark, d):
    """S1 and S2 on files that Spark writes from lineitem in arrival order, then Q3: of the lines of one user and item
    the last one counts, across part files."""
    from .session import scratch_path
    from .sources.text import read_ratings
    lines = tb.rating_lines_from_orders(spark, d)
    path = scratch_path(spark, "lines")
    # part files of bounded size, in the order of arrival (the count reads the files' footers)
    parts = max(8, ceil(tb.table(spark, d, "lineitem").count() / LINES_PER_FILE))
    (lines.repartitionByRange(parts, "ord").sortWithinPartitions("ord", "rating")
     .select(F.format_string("%d\t%d\t%d\t%d", F.col("user") + 1, F.col("item") + 1, F.col("rating").cast("int"), "ord").alias("value"))
     .write.text(path))
    return rt.cells(read_ratings(spark, path))


@register("s3_parse_items", """
SELECT CAST(p_partkey AS BIGINT) AS item, p_name AS name FROM part WHERE p_size >= 5""")
def q_s3_parse_items(spark, d):
    """Title lines ``id|name|brand`` (1-based); parts with size < 5 give a bare ``id|`` (dropped)."""
    from .sources.text import parse_items
    p = tb.table(spark, d, "part")
    line = F.when(F.col("p_size") < 5, F.format_string("%d|", F.col("p_partkey") + 1)).otherwise(
        F.format_string("%d|%s|%s", F.col("p_partkey") + 1, F.col("p_name"), F.col("p_brand")))
    return parse_items(p.select(line.alias("value")))


@register("p4_parse_requests", """
SELECT c_custkey AS line_id, 0 AS pos, CAST(c_custkey AS BIGINT) AS "user" FROM customer
UNION ALL
SELECT c_custkey AS line_id, 1 AS pos, CAST(c_nationkey AS BIGINT) AS "user" FROM customer""")
def q_p4_parse_requests(spark, d):
    """Request lines `` <custkey>, <nationkey>`` (leading blank, Q19)."""
    from .sources.text import parse_requests
    c = tb.table(spark, d, "customer")
    lines = c.select("c_custkey", F.format_string(" %d, %d", "c_custkey", "c_nationkey").alias("value"))
    return parse_requests(lines, "c_custkey")


# ------------------------------------------------------------------ V5/V6 flatten
NS_EV = "ns AS (SELECT MAX(\"user\") + 1 AS n FROM r)"


@register("v5_flatten_params", with_sql(R_EV_SQL, DET_SQL, NS_EV) + """
SELECT CAST(id * 2 + k AS BIGINT) AS pos, 'user' AS side, id, k, round(CASE k WHEN 0 THEN f0 ELSE f1 END, 6) AS value
FROM uf, (SELECT 0 AS k UNION ALL SELECT 1) ks
UNION ALL
SELECT CAST(ns.n * 2 + id * 2 + k AS BIGINT) AS pos, 'item' AS side, id, k,
       round(CASE k WHEN 0 THEN f0 ELSE f1 END, 6) AS value
FROM vf, ns, (SELECT 0 AS k UNION ALL SELECT 1) ks""")
def q_v5_flatten(spark, d):
    from .operators.params import flatten_params
    r = _r_ev(spark, d)
    uf, vf = tb.det_model(r)
    fl = flatten_params(uf, vf, rt.dims(r).n_users, 2)
    return fl.select("pos", "side", "id", "k", r6("value").alias("value"))


@register("v6_unflatten_params", with_sql(R_EV_SQL, DET_SQL) + """
SELECT 'user' AS side, id, round(f0, 6) AS f0, round(f1, 6) AS f1 FROM uf
UNION ALL SELECT 'item' AS side, id, round(f0, 6) AS f0, round(f1, 6) AS f1 FROM vf""")
def q_v6_unflatten(spark, d):
    """Round trip: padded factors → flat vector → factors (ids 0..n-1, 0..m-1 all present in r_ev)."""
    from .operators.params import flatten_params, unflatten_params
    r = _r_ev(spark, d)
    dm = rt.dims(r)
    uf, vf = tb.det_model(r)
    fl = flatten_params(uf, vf, dm.n_users, 2)
    u2, v2, _ = unflatten_params(fl, dm.n_users, dm.n_items)
    return (u2.select(F.lit("user").alias("side"), "id", *_flat2(None))
            .unionByName(v2.select(F.lit("item").alias("side"), "id", *_flat2(None))))


# ------------------------------------------------------------------ V3/V4 elementwise
@register("v3_elementwise", with_sql(R_EV_SQL, DET_SQL) + """
SELECT u.id, round(u.f0 - v.f0, 6) AS d0, round(u.f1 - v.f1, 6) AS d1, round(u.f0 * v.f0, 6) AS p0, round(u.f1 * v.f1, 6) AS p1,
       round(u.f0 / 4.0e0, 6) AS s0, round(u.f1 / 4.0e0, 6) AS s1
FROM uf u JOIN vf v ON v.id = u.id""")
def q_v3_elementwise(spark, d):
    """Difference, product and quotient by a number of the user and item vectors that share an id."""
    from .functions.vectors import vec_mul, vec_scale, vec_sub
    uf, vf = tb.det_model(_r_ev(spark, d))
    j = uf.select("id", F.col("features").alias("u")).join(vf.select("id", F.col("features").alias("v")), "id").select(
        "id", vec_sub("u", "v").alias("d"), vec_mul("u", "v").alias("p"), vec_scale("u", 0.25).alias("s"))
    return j.select("id", *[c for name in "dps" for c in _flat2(None, name, name)])


# ------------------------------------------------------------------ A8/A9/A10 sums
@register("a8_sq_diff", with_sql(R_ORD_SQL, DET_SQL) + HALF_ITEM_SQL + """,
h AS (SELECT id, (c*y0 - b*y1) / (a*c - b*b) AS f0, (a*y1 - b*y0) / (a*c - b*b) AS f1 FROM g)
SELECT round(SUM((h.f0 - vf.f0)*(h.f0 - vf.f0) + (h.f1 - vf.f1)*(h.f1 - vf.f1)), 6) AS sq_diff
FROM h JOIN vf ON vf.id = h.id""")
def q_a8_sq_diff(spark, d):
    """Distance between the item factors before and after one half-step."""
    r = _r_ord(spark, d)
    uf, vf = tb.det_model(r)
    h = rg.als_half_step(r, uf, "user", "item", 2, LAM)
    return objective.sq_diff_frame(h, vf, 2).select(r6("sq_diff").alias("sq_diff"))


@register("a9_sq_norm", with_sql(R_ORD_SQL, DET_SQL) + """
SELECT 'user' AS side, round(SUM(f0*f0 + f1*f1), 6) AS sq_norm, round(sqrt(SUM(f0*f0 + f1*f1)), 6) AS norm FROM uf
UNION ALL
SELECT 'item' AS side, round(SUM(f0*f0 + f1*f1), 6) AS sq_norm, round(sqrt(SUM(f0*f0 + f1*f1)), 6) AS norm FROM vf""")
def q_a9_sq_norm(spark, d):
    r = _r_ord(spark, d)
    uf, vf = tb.det_model(r)
    a = objective.sq_norm_frame(uf, 2).select(F.lit("user").alias("side"), r6("sq_norm").alias("sq_norm"),
                                              r6("norm").alias("norm"))
    b = objective.sq_norm_frame(vf, 2).select(F.lit("item").alias("side"), r6("sq_norm").alias("sq_norm"),
                                              r6("norm").alias("norm"))
    return a.unionByName(b)


@register("a10_param_dots", with_sql(R_ORD_SQL, DET_SQL, NR_SQL) + GRAD_SQL + """
SELECT round(1.0e6 * (SELECT SUM(du.f0*du.f0 + du.f1*du.f1) FROM du) + 1.0e6 * (SELECT SUM(di.f0*di.f0 + di.f1*di.f1) FROM di), 6) AS gg,
       round((SELECT SUM(du.f0*uf.f0 + du.f1*uf.f1) FROM du JOIN uf ON uf.id = du.id)
           + (SELECT SUM(di.f0*vf.f0 + di.f1*vf.f1) FROM di JOIN vf ON vf.id = di.id), 6) AS gx""")
def q_a10_param_dots(spark, d):
    """gᵀg (×10⁶, the gradient is small) and gᵀx at the deterministic point."""
    r = _r_ord(spark, d)
    uf, vf = tb.det_model(r)
    du, di = objective.gradient(r, uf, vf, 2, LAM, r.count())
    gg = objective.param_dots_frame((du, di), (du, di), 2).select((F.col("dot") * 1.0e6).alias("gg"))
    gx = objective.param_dots_frame((du, di), (uf, vf), 2).select(F.col("dot").alias("gx"))
    return gg.unionByName(gx, allowMissingColumns=True).agg(r6(F.max("gg")).alias("gg"), r6(F.max("gx")).alias("gx"))


# ------------------------------------------------------------------ A11 line polynomial
@register("a11_line_poly", with_sql(R_ORD_SQL, DET_SQL, NR_SQL) + GRAD_SQL + """,
q AS (SELECT (u.f0*v.f0 + u.f1*v.f1) - r.rating AS e,
             -((u.f0*dv.f0 + u.f1*dv.f1) + (du.f0*v.f0 + du.f1*v.f1)) AS p,
             du.f0*dv.f0 + du.f1*dv.f1 AS q
      FROM r JOIN uf u ON u.id = r."user" JOIN du ON du.id = r."user"
             JOIN vf v ON v.id = r.item JOIN di dv ON dv.id = r.item),
s AS (SELECT SUM(e*e) AS ee, SUM(e*p) AS ep, SUM(p*p + 2.0e0*e*q) AS pp2eq, SUM(p*q) AS pq, SUM(q*q) AS qq FROM q),
x AS (SELECT SUM(xx) AS xx, SUM(xd) AS xd, SUM(dd) AS dd FROM (
        SELECT u.f0*u.f0 + u.f1*u.f1 AS xx, u.f0*du.f0 + u.f1*du.f1 AS xd, du.f0*du.f0 + du.f1*du.f1 AS dd
        FROM uf u JOIN du ON du.id = u.id
        UNION ALL
        SELECT v.f0*v.f0 + v.f1*v.f1, v.f0*di.f0 + v.f1*di.f1, di.f0*di.f0 + di.f1*di.f1
        FROM vf v JOIN di ON di.id = v.id))
SELECT round((0.5e0*ee + 0.5e0*0.01e0*xx) / n, 6) AS c0, round((ep - 0.01e0*xd) / n * 1.0e3, 6) AS c1,
       round((0.5e0*pp2eq + 0.5e0*0.01e0*dd) / n * 1.0e6, 6) AS c2, round(pq / n * 1.0e9, 6) AS c3,
       round(0.5e0*qq / n * 1.0e12, 6) AS c4
FROM s, x, nr""")
def q_a11_line_poly(spark, d):
    """Coefficients of a ↦ loss(x − a·∇f) at the deterministic point; cⱼ scaled by 10^(3j)
    (the gradient is O(10⁻³))."""
    r = _r_ord(spark, d)
    uf, vf = tb.det_model(r)
    n = r.count()
    du, di = objective.gradient(r, uf, vf, 2, LAM, n)
    c = objective.line_poly_frame(r, uf, vf, du, di, 2, LAM, n)
    return c.select(*[r6(F.col(f"c{j}") * (10.0 ** (3 * j))).alias(f"c{j}") for j in range(5)])


# ------------------------------------------------------------------ M8/M9 ridge
def _ridge2_sql(by: str, weight: str, lam: str) -> str:
    sel = f"{by}, " if by else ""
    grp = f"GROUP BY {by}" if by else ""
    return f"""
WITH g AS (SELECT {sel}SUM({weight}*l_discount*l_discount) + {lam} AS a, SUM({weight}*l_discount*l_tax) AS b,
                  SUM({weight}*l_tax*l_tax) + {lam} AS c, SUM({weight}*l_discount*l_quantity) AS y0,
                  SUM({weight}*l_tax*l_quantity) AS y1
           FROM lineitem {grp})
SELECT {sel}round((c*y0 - b*y1) / (a*c - b*b), 6) AS c0, round((a*y1 - b*y0) / (a*c - b*b), 6) AS c1 FROM g"""


@register("m8_ridge", _ridge2_sql("", "1.0e0", "1.0e0"))
def q_m8_ridge(spark, d):
    """Quantity on (discount, tax) over all of lineitem, λ = 1."""
    li = tb.table(spark, d, "lineitem")
    res = rg.ridge(li, ["l_discount", "l_tax"], "l_quantity", 1.0)
    return res.select(r6(F.col("coef").getItem(0)).alias("c0"), r6(F.col("coef").getItem(1)).alias("c1"))


@register("m9_weighted_ridge", _ridge2_sql("l_returnflag", "CAST(l_linenumber AS DOUBLE)", "0.5e0"))
def q_m9_weighted_ridge(spark, d):
    """Per return flag, weights = line number, λ = 0.5."""
    li = tb.table(spark, d, "lineitem")
    res = rg.weighted_ridge(li, ["l_discount", "l_tax"], "l_quantity", "l_linenumber", 0.5, by=["l_returnflag"])
    return res.select("l_returnflag", r6(F.col("coef").getItem(0)).alias("c0"),
                      r6(F.col("coef").getItem(1)).alias("c1"))


def _near_columns_sql(by: str, weight: str) -> str:
    """Coefficients on d and d + 1e-6·t from the well-conditioned regression on d and t: b = 1e6·q, a = p − b."""
    sel, grp = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return f"""
WITH g AS (SELECT {sel}SUM({weight}*l_discount*l_discount) AS a, SUM({weight}*l_discount*l_tax) AS b, SUM({weight}*l_tax*l_tax) AS c,
                  SUM({weight}*l_discount*l_quantity) AS y0, SUM({weight}*l_tax*l_quantity) AS y1 FROM lineitem {grp}),
h AS (SELECT {sel}(c*y0 - b*y1) / (a*c - b*b) AS p, (a*y1 - b*y0) / (a*c - b*b) AS q FROM g)
SELECT {sel}round((p - 1e6*q) / 1e6, 5) AS c0_millions, round(q, 5) AS c1_millions FROM h"""


def _near_columns(spark, d):
    return tb.table(spark, d, "lineitem").withColumn("near", F.col("l_discount") + F.lit(1e-6) * F.col("l_tax"))


def _millions(res, *keys):
    return res.select(*keys, *[F.round(F.col("coef").getItem(j) / F.lit(1e6), 5).alias(f"c{j}_millions") for j in range(2)])


@register("m8_ridge_orthogonal", _near_columns_sql("", "1.0e0"))
def q_m8_ridge_orthogonal(spark, d):
    """Least squares (λ = 0) of quantity on two columns 1e-6 apart, by QR."""
    from .operators.orthogonal import ridge_qr
    return _millions(ridge_qr(_near_columns(spark, d), ["l_discount", "near"], "l_quantity", 0.0))


@register("m9_ridge_orthogonal", _near_columns_sql("l_returnflag", "CAST(l_linenumber AS DOUBLE)"))
def q_m9_ridge_orthogonal(spark, d):
    """The same per return flag, weights = line number."""
    from .operators.orthogonal import ridge_qr
    res = ridge_qr(_near_columns(spark, d), ["l_discount", "near"], "l_quantity", 0.0, "l_linenumber", ["l_returnflag"], fan=2)
    return _millions(res, "l_returnflag")


# ------------------------------------------------------------------ M4 unrolled descent + W1/W2/T3
GD_STEP = 100.0
GD_STEPS = 3


def _gd_unroll_sql(steps: int, a: float) -> str:
    parts = [R_ORD_SQL, DET_SQL, NR_SQL, "u0 AS (SELECT * FROM uf)", "v0 AS (SELECT * FROM vf)"]
    za = f"({-a!r}e0)" if "e" not in repr(-a) else f"({-a!r})"
    for t in range(steps + 1):
        if t > 0:
            parts.append(f"""l{t} AS (
  SELECT 0.5e0 * ((SELECT SUM((r.rating - (u.f0*v.f0 + u.f1*v.f1)) * (r.rating - (u.f0*v.f0 + u.f1*v.f1)))
                   FROM r JOIN u{t} u ON u.id = r."user" JOIN v{t} v ON v.id = r.item)
                 + 0.01e0 * (SELECT SUM(f0*f0 + f1*f1) FROM u{t}) + 0.01e0 * (SELECT SUM(f0*f0 + f1*f1) FROM v{t}))
         / (SELECT n FROM nr) AS loss)""")
        if t == steps:
            break
        parts.append(f"""e{t} AS (SELECT r."user", r.item, (u.f0*v.f0 + u.f1*v.f1) - r.rating AS delta,
             u.f0 AS u0, u.f1 AS u1, v.f0 AS v0, v.f1 AS v1
      FROM r JOIN u{t} u ON u.id = r."user" JOIN v{t} v ON v.id = r.item)""")
        parts.append(f"""gu{t} AS (SELECT "user" AS id, SUM(delta*v0) AS g0, SUM(delta*v1) AS g1 FROM e{t} GROUP BY 1)""")
        parts.append(f"""gi{t} AS (SELECT item AS id, SUM(delta*u0) AS g0, SUM(delta*u1) AS g1 FROM e{t} GROUP BY 1)""")
        for side, g in (("u", "gu"), ("v", "gi")):
            parts.append(f"""{side}{t + 1} AS (SELECT x.id,
  x.f0 + {za} * ((coalesce(g.g0, 0.0e0) + 0.01e0*x.f0) / (SELECT n FROM nr)) AS f0,
  x.f1 + {za} * ((coalesce(g.g1, 0.0e0) + 0.01e0*x.f1) / (SELECT n FROM nr)) AS f1
  FROM {side}{t} x LEFT JOIN {g}{t} g ON g.id = x.id)""")
    hist = " UNION ALL ".join(f"SELECT {t} AS iter, loss FROM l{t + 1}" for t in range(steps))
    parts.append(f"h AS ({hist})")
    return with_sql(*parts)


def _gd_history(spark, d):
    from .operators.params import Params
    from .plans.descent import Problem, fit_gd_fixed
    r = _r_ord_once(spark, d)
    uf, vf = _det_once(r)
    prob = Problem(r, 2, LAM, float(r.count()))
    fit = fit_gd_fixed(prob, Params(uf, vf), GD_STEP, 0.0, max_iter=GD_STEPS)
    drop_all(r, uf, vf, fit.params.whole)
    return fit.trace.frame(spark)


@register("m4_gd_fixed", _gd_unroll_sql(GD_STEPS, GD_STEP) + """
SELECT iter, round(loss, 6) AS loss,
       round(coalesce(loss / lag(loss) OVER (ORDER BY iter), 0.5e0), 6) AS red FROM h""")
def q_m4_gd_fixed(spark, d):
    """Three fixed steps (a = 100, ε = 0) from the deterministic point; the trace."""
    h = _gd_history(spark, d)
    return h.select("iter", r6("loss").alias("loss"), r6("red").alias("red"))


@register("w1_shrink", _gd_unroll_sql(GD_STEPS, GD_STEP) + """,
w AS (SELECT iter, loss, coalesce(loss / lag(loss) OVER (ORDER BY iter), 0.5e0) AS red FROM h)
SELECT iter, round(red, 6) AS red,
       round(1.0e0 - avg(red) OVER (ORDER BY iter ROWS BETWEEN 1 PRECEDING AND CURRENT ROW), 6) AS shrink
FROM w ORDER BY iter DESC LIMIT 2""")
def q_w1_shrink(spark, d):
    """W2 (ratio by lag), W1 (shrink over the latest 2 rows) and T3 (newest 2 rows) on the M4 trace."""
    from .operators.diagnostics import latest, shrink, with_reduction
    h = _gd_history(spark, d).select("iter", "loss")
    s = shrink(with_reduction(h), 2)
    return latest(s, 2).select("iter", r6("red").alias("red"), r6("shrink").alias("shrink"))


# ------------------------------------------------------------------ M3 unrolled ALS
def _als_unroll_sql(sweeps: int) -> str:
    parts = [R_ORD_SQL, DET_SQL, "u0 AS (SELECT * FROM uf)"]

    def solve(name, src, fixed_key, out_key):
        return f"""{name} AS (SELECT id, (c*y0 - b*y1) / (a*c - b*b) AS f0, (a*y1 - b*y0) / (a*c - b*b) AS f1 FROM (
  SELECT r.{out_key} AS id, SUM(x.f0*x.f0) + 0.01e0 AS a, SUM(x.f0*x.f1) AS b, SUM(x.f1*x.f1) + 0.01e0 AS c,
         SUM(x.f0*r.rating) AS y0, SUM(x.f1*r.rating) AS y1
  FROM r JOIN {src} x ON x.id = r.{fixed_key} GROUP BY r.{out_key}))"""
    for t in range(1, sweeps + 1):
        parts.append(solve(f"v{t}", f"u{t - 1}", '"user"', "item"))
        parts.append(solve(f"u{t}", f"v{t}", "item", '"user"'))
    return with_sql(*parts) + f"""
SELECT 'user' AS side, id, round(f0, 6) AS f0, round(f1, 6) AS f1 FROM u{sweeps}
UNION ALL SELECT 'item' AS side, id, round(f0, 6) AS f0, round(f1, 6) AS f1 FROM v{sweeps}"""


@register("m3_als", _als_unroll_sql(2))
def q_m3_als(spark, d):
    """Two sweeps of our ALS (rank 2, λ 0.01) from the deterministic point."""
    from .operators.params import Params
    from .plans.als import als_sweeps
    r = _r_ord(spark, d)
    dm = rt.dims(r)
    uf, vf = tb.det_model(r)
    x = als_sweeps(r, Params(uf, vf), 2, LAM, 2, dm.n_users, dm.n_items)
    return (x.uf.select(F.lit("user").alias("side"), "id", *_flat2(None))
            .unionByName(x.vf.select(F.lit("item").alias("side"), "id", *_flat2(None))))


# ------------------------------------------------------------------ D1/D2/D3 gradient checks
def _points(spark, d):
    li = tb.table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.col("l_discount").alias("x0"), F.col("l_tax").alias("x1"),
                     (F.col("l_quantity") / F.lit(50.0)).alias("x2"))


def _f_poly(v):
    return F.lit(3.0) * v["x0"] * v["x0"] * v["x0"] - F.lit(4.0) * v["x1"] * v["x0"] + F.lit(6.0) * v["x2"]


_F_SQL = "(3.0e0*({a})*({a})*({a}) - 4.0e0*({b})*({a}) + 6.0e0*({c}))"


def _fsql(a="x0", b="x1", c="x2"):
    return _F_SQL.format(a=a, b=b, c=c)


@register("d1_numeric_gradient", f"""
WITH p AS (SELECT l_orderkey, l_linenumber, l_discount AS x0, l_tax AS x1, l_quantity / 50.0e0 AS x2 FROM lineitem),
g AS (SELECT l_orderkey, l_linenumber, x0, x1, x2,
  ({_fsql("x0 + 0.001e0")} - {_fsql("x0 - 0.001e0")}) / 0.002e0 AS ng_x0,
  ({_fsql(b="x1 + 0.001e0")} - {_fsql(b="x1 - 0.001e0")}) / 0.002e0 AS ng_x1,
  ({_fsql(c="x2 + 0.001e0")} - {_fsql(c="x2 - 0.001e0")}) / 0.002e0 AS ng_x2 FROM p)
SELECT l_orderkey, l_linenumber, round(ng_x0, 6) AS ng_x0, round(ng_x1, 6) AS ng_x1, round(ng_x2, 6) AS ng_x2,
       round(1.0e6 * ((ng_x0 - (9.0e0*x0*x0 - 4.0e0*x1)) * (ng_x0 - (9.0e0*x0*x0 - 4.0e0*x1))
                    + (ng_x1 + 4.0e0*x0) * (ng_x1 + 4.0e0*x0) + (ng_x2 - 6.0e0) * (ng_x2 - 6.0e0)), 6) AS sq_dist_e6
FROM g""")
def q_d1_numeric_gradient(spark, d):
    """Central differences (ε = 0.001) of f = 3x0³ − 4x1x0 + 6x2 on lineitem
    points, and the squared distance to the analytic gradient (×10⁶)."""
    from .operators.diagnostics import verify_gradient
    grads = {"x0": lambda v: F.lit(9.0) * v["x0"] * v["x0"] - F.lit(4.0) * v["x1"],
             "x1": lambda v: F.lit(-4.0) * v["x0"],
             "x2": lambda v: F.lit(6.0) + F.lit(0.0) * v["x2"]}
    v = verify_gradient(_points(spark, d), _f_poly, grads, ["x0", "x1", "x2"], 1e-3)
    return v.select("l_orderkey", "l_linenumber", *[r6("ng_" + c).alias("ng_" + c) for c in ("x0", "x1", "x2")],
                    r6(F.col("sq_dist") * 1.0e6).alias("sq_dist_e6"))


@register("d3_check_mf_gradient", with_sql(R_EV_SQL, DET_SQL, NR_SQL) + GRAD_SQL + """,
j AS (SELECT r.rating - (u.f0*v.f0 + u.f1*v.f1) AS e, r."user", r.item, u.f0 AS u0, u.f1 AS u1, v.f0 AS v0, v.f1 AS v1
      FROM r JOIN uf u ON u.id = r."user" JOIN vf v ON v.id = r.item),
su AS (SELECT "user" AS id,
         SUM(0.5e0 * ((e - 0.001e0*v0)*(e - 0.001e0*v0) - (e + 0.001e0*v0)*(e + 0.001e0*v0))) AS s0,
         SUM(0.5e0 * ((e - 0.001e0*v1)*(e - 0.001e0*v1) - (e + 0.001e0*v1)*(e + 0.001e0*v1))) AS s1
       FROM j GROUP BY 1),
si AS (SELECT item AS id,
         SUM(0.5e0 * ((e - 0.001e0*u0)*(e - 0.001e0*u0) - (e + 0.001e0*u0)*(e + 0.001e0*u0))) AS s0,
         SUM(0.5e0 * ((e - 0.001e0*u1)*(e - 0.001e0*u1) - (e + 0.001e0*u1)*(e + 0.001e0*u1))) AS s1
       FROM j GROUP BY 1),
num AS (
  SELECT 'user' AS side, x.id, 0 AS k, (coalesce(s.s0, 0.0e0) + 0.005e0 * ((x.f0 + 0.001e0)*(x.f0 + 0.001e0) - (x.f0 - 0.001e0)*(x.f0 - 0.001e0))) / nr.n / 0.002e0 AS numeric
    FROM uf x LEFT JOIN su s ON s.id = x.id, nr
  UNION ALL
  SELECT 'user', x.id, 1, (coalesce(s.s1, 0.0e0) + 0.005e0 * ((x.f1 + 0.001e0)*(x.f1 + 0.001e0) - (x.f1 - 0.001e0)*(x.f1 - 0.001e0))) / nr.n / 0.002e0
    FROM uf x LEFT JOIN su s ON s.id = x.id, nr
  UNION ALL
  SELECT 'item', x.id, 0, (coalesce(s.s0, 0.0e0) + 0.005e0 * ((x.f0 + 0.001e0)*(x.f0 + 0.001e0) - (x.f0 - 0.001e0)*(x.f0 - 0.001e0))) / nr.n / 0.002e0
    FROM vf x LEFT JOIN si s ON s.id = x.id, nr
  UNION ALL
  SELECT 'item', x.id, 1, (coalesce(s.s1, 0.0e0) + 0.005e0 * ((x.f1 + 0.001e0)*(x.f1 + 0.001e0) - (x.f1 - 0.001e0)*(x.f1 - 0.001e0))) / nr.n / 0.002e0
    FROM vf x LEFT JOIN si s ON s.id = x.id, nr),
ana AS (SELECT 'user' AS side, id, 0 AS k, f0 AS analytic FROM du UNION ALL SELECT 'user', id, 1, f1 FROM du
        UNION ALL SELECT 'item', id, 0, f0 FROM di UNION ALL SELECT 'item', id, 1, f1 FROM di)
SELECT num.side, num.id, num.k, round(numeric * 1.0e3, 6) AS numeric, round(analytic * 1.0e3, 6) AS analytic
FROM num JOIN ana ON ana.side = num.side AND ana.id = num.id AND ana.k = num.k""")
def q_d3_check_mf_gradient(spark, d):
    """Numeric (ε = 0.001) vs analytic gradient of the loss for every coordinate (×10³)."""
    from .operators.diagnostics import check_mf_gradient
    r = _r_ev(spark, d)
    uf, vf = tb.det_model(r)
    c = check_mf_gradient(r, uf, vf, 2, LAM, float(r.count()), 1e-3)
    return c.select("side", "id", F.col("k").cast("int").alias("k"), r6(F.col("numeric") * 1.0e3).alias("numeric"),
                    r6(F.col("analytic") * 1.0e3).alias("analytic"))


# ------------------------------------------------------------------ R2 predict
@register("r2_predict", with_sql(R_EV_SQL, DET_SQL) + """
SELECT r."user", r.item, round(uf.f0*vf.f0 + uf.f1*vf.f1, 6) AS pred
FROM r JOIN uf ON uf.id = r."user" JOIN vf ON vf.id = r.item""")
def q_r2_predict(spark, d):
    r = _r_ev(spark, d)
    uf, vf = tb.det_model(r)
    return rt.predict(r, uf, vf, 2).select("user", "item", r6("pred").alias("pred"))


# ------------------------------------------------------------------ R4 nested / S7 report (on r_ev)
RECS_EV_SQL = with_sql(R_EV_SQL, DET_SQL) + """,
c AS (SELECT uf.id AS "user", vf.id AS item, uf.f0*vf.f0 + uf.f1*vf.f1 AS score
      FROM uf, vf WHERE NOT EXISTS (SELECT 1 FROM r WHERE r."user" = uf.id AND r.item = vf.id)),
t AS (SELECT "user", item, score, row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS position
      FROM c QUALIFY position <= 20),
tn AS (SELECT t.*, coalesce(p.p_name, '') AS name FROM t LEFT JOIN part p ON CAST(p.p_partkey AS INT) = t.item)"""


def _ev_recs(spark, d):
    r = _r_ev(spark, d)
    uf, vf = tb.det_model(r)
    requests = uf.select(F.col("id").alias("req_pos"), F.col("id").alias("user"))
    recs = rc.recommend(uf, vf, r, requests, k=20, rank=2, items=tb.items_from_parts(spark, d))
    return recs, requests, uf


@register("r4_recommend_nested", RECS_EV_SQL + """
SELECT uf.id AS req_pos, uf.id AS "user", COUNT(tn.item) AS n_recs,
       coalesce(string_agg(tn.name, '|' ORDER BY tn.position), '') AS names
FROM uf LEFT JOIN tn ON tn."user" = uf.id GROUP BY uf.id""")
def q_r4_recommend_nested(spark, d):
    recs, requests, uf = _ev_recs(spark, d)
    nested = rc.recommend_nested(recs, requests, uf)
    return nested.select("req_pos", "user", F.size("recommendations").cast("long").alias("n_recs"),
                         F.array_join(F.transform("recommendations", lambda x: x["name"]), "|").alias("names"))


@register("s7_report", RECS_EV_SQL + """
SELECT "user" AS req_pos, 0 AS line_no, printf('Recommendation for user %d:', "user") AS line
FROM (SELECT id AS "user" FROM uf)
UNION ALL
SELECT "user", CAST(position AS INT), printf('    Rank: %.3f   Movie: %s', score, name) FROM tn
UNION ALL
SELECT uf.id, CAST(coalesce(MAX(tn.position), 0) + 1 AS INT), '' FROM uf LEFT JOIN tn ON tn."user" = uf.id GROUP BY uf.id""")
def q_s7_report(spark, d):
    recs, requests, uf = _ev_recs(spark, d)
    return rc.report(recs, requests, uf).select("req_pos", F.col("line_no").cast("int").alias("line_no"), "line")


@register("s7_report_files", RECS_EV_SQL + """,
l AS (SELECT id AS "user", 0 AS line_no, printf('Recommendation for user %d:', id) AS line FROM uf
      UNION ALL SELECT "user", CAST(position AS INT), printf('    Rank: %.3f   Movie: %s', score, name) FROM tn
      UNION ALL SELECT uf.id, CAST(coalesce(MAX(tn.position), 0) + 1 AS INT), '' FROM uf LEFT JOIN tn ON tn."user" = uf.id GROUP BY uf.id)
SELECT row_number() OVER (ORDER BY "user", line_no) AS n, line FROM l""")
def q_s7_report_files(spark, d):
    """The report written as text files and read back: every line with its place in the whole."""
    from .session import scratch_path
    from .sources.text import read_written_lines, write_lines
    recs, requests, uf = _ev_recs(spark, d)
    path = scratch_path(spark, "report")
    write_lines(rc.report(recs, requests, uf), path, ["req_pos", "user", "line_no"])
    return read_written_lines(spark, path).select("n", F.col("value").alias("line"))


# ------------------------------------------------------------------ R5 request stream
@register("r5_recommend_stream", with_sql(R_ORD_SQL, DET_SQL) + """,
req AS (SELECT CAST(c_custkey AS BIGINT) AS "user" FROM customer UNION ALL SELECT CAST(c_nationkey AS BIGINT) FROM customer),
c AS (SELECT uf.id AS "user", vf.id AS item, uf.f0*vf.f0 + uf.f1*vf.f1 AS score
      FROM uf, vf WHERE NOT EXISTS (SELECT 1 FROM r WHERE r."user" = uf.id AND r.item = vf.id)),
t AS (SELECT "user", item, score, row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS position
      FROM c QUALIFY position <= 20)
SELECT t."user", CAST(t.position AS INT) AS position, t.item, round(t.score, 6) AS score,
       coalesce(p.p_name, '') AS name
FROM req JOIN t ON t."user" = req."user" LEFT JOIN part p ON CAST(p.p_partkey AS INT) = t.item""")
def q_r5_recommend_stream(spark, d):
    """Request lines `` <custkey>, <nationkey>`` written by Spark from customer,
    answered by the file-source stream (availableNow) through foreachBatch."""
    from .plans.model import FactorModel, save_model
    from .session import scratch_path
    from .streaming.requests import recommend_stream
    r = _r_ord_once(spark, d)
    uf, vf = _det_once(r)
    base = scratch_path(spark, "r5")
    dm = rt.dims(r)
    save_model(FactorModel(uf, vf, rt.seen_pairs(r), tb.items_from_parts(spark, d),
                           {"rank": 2, "n_users": dm.n_users, "n_items": dm.n_items, "trainer": 0, "lam": LAM, "eps": 0.001,
                            "seed": 8}), f"{base}/model")
    c = tb.table(spark, d, "customer")
    c.select(F.format_string(" %d, %d", "c_custkey", "c_nationkey").alias("value")).write.text(f"{base}/in")
    q = recommend_stream(spark, f"{base}/in", f"{base}/model", f"{base}/out", f"{base}/ckpt", k=20)
    q.awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    return out.select("user", "position", "item", r6("score").alias("score"), "name")


# ------------------------------------------------------------------ S4/S5 model store
def _stored(spark, d):
    from .plans.model import FactorModel, save_model
    from .session import scratch_path
    r = _r_ord_once(spark, d)
    uf, vf = _det_once(r)
    dm = rt.dims(r)
    m = FactorModel(uf, vf, rt.seen_pairs(r), tb.items_from_parts(spark, d),
                    {"rank": 2, "n_users": dm.n_users, "n_items": dm.n_items, "trainer": 0, "lam": LAM,
                     "eps": 0.001, "seed": 8})
    path = scratch_path(spark, "model")
    return save_model(m, path), path, r


@register("s4_save_load_model", with_sql(R_ORD_SQL, DET_SQL) + """
SELECT 'user' AS part, id, 0 AS other, round(f0, 6) AS f0, round(f1, 6) AS f1, '' AS name FROM uf
UNION ALL SELECT 'item', id, 0, round(f0, 6), round(f1, 6), '' FROM vf
UNION ALL SELECT 'seen', "user", item, 0.0e0, 0.0e0, '' FROM r
UNION ALL SELECT 'title', p_partkey, 0, 0.0e0, 0.0e0, p_name FROM part
UNION ALL SELECT 'meta', MAX("user") + 1, MAX(item) + 1, 2.0e0, 0.01e0, '' FROM r""")
def q_s4_save_load(spark, d):
    """Every table of a stored model (gzip Parquet under the checkpoint folder), read back."""
    from .operators.seen_sets import seen_items
    back, _, _ = _stored(spark, d)
    zero, none = F.lit(0.0), F.lit("")

    def part(df, name, id_, other=F.lit(0), f0=zero, f1=zero, text=none):
        return df.select(F.lit(name).alias("part"), F.col(id_).alias("id"), other.cast("long").alias("other"),
                         r6(f0).alias("f0"), r6(f1).alias("f1"), text.alias("name"))
    f = [F.col("features")[j] for j in range(2)]
    meta = spark.createDataFrame([(back.meta["n_users"], back.meta["n_items"], float(back.rank), back.meta["lam"])],
                                 "n long, m long, k double, lam double")
    return (part(back.user_factors, "user", "id", f0=f[0], f1=f[1]).unionByName(part(back.item_factors, "item", "id", f0=f[0], f1=f[1]))
            .unionByName(part(seen_items(back.seen), "seen", "user", other=F.col("item"))).unionByName(part(back.items, "title", "item", text=F.col("name")))
            .unionByName(part(meta, "meta", "n", other=F.col("m"), f0=F.col("k"), f1=F.col("lam"))))


@register("s6_fit_or_load", with_sql(R_ORD_SQL, DET_SQL) + """
SELECT id, round(f0, 6) AS f0, round(f1, 6) AS f1, true AS reused FROM vf
UNION ALL SELECT MAX(item) + 1, CAST(COUNT(DISTINCT "user") AS DOUBLE), 0.0e0, false FROM r""")
def q_s6_fit_or_load(spark, d):
    """A stored model is reused as it is; without one the library trains: its item ids reach the largest one, it has a vector
    for every rated user (f0), and none of them misses its optimality conditions (f1)."""
    from .operators.optimality import nnls_violations
    from .plans.model import fit_or_load
    back, path, r = _stored(spark, d)
    again = fit_or_load(r, path, reuse=True)
    new = fit_or_load(r, path + "-new", reuse=True, rank=2)
    far = nnls_violations(r, new.user_factors, new.item_factors, "user", "item", 2, LAM).agg(
        F.count(F.lit(1)).cast("double").alias("f0"), F.count_if(~(F.col("violation") <= ROUNDING * F.col("scale"))).cast("double").alias("f1"))
    n = new.item_factors.agg((F.max("id") + 1).alias("id")).join(F.broadcast(far)).select(
        "id", "f0", "f1", F.lit(new.meta["version"] == back.meta["version"]).alias("reused"))
    return again.item_factors.select("id", *_flat2(None), F.lit(again.meta["version"] == back.meta["version"]).alias("reused")).unionByName(n)


# ------------------------------------------------------------------ pixels
PX_SQL = """WITH q AS (SELECT l_orderkey AS image_id, CAST(l_linenumber AS INT) AS x, CAST(l_partkey AS INT) AS y,
                 CASE WHEN l_linenumber = 7 THEN (l_partkey % 256) * 65793 + (l_suppkey % 256) * 16777216
                      ELSE (l_partkey*2654435761 + l_orderkey*40503) % 4294967296 END AS w FROM lineitem),
p AS (SELECT image_id, x, y, w, CAST(CASE WHEN w >= 2147483648 THEN w - 4294967296 ELSE w END AS INT) AS px FROM q),
c AS (SELECT image_id, x, y, px, w & 255 AS r, (w >> 8) & 255 AS g, (w >> 16) & 255 AS b, (w >> 24) & 255 AS a FROM p)"""


@register("x1_channels", PX_SQL + """
SELECT image_id, x, y, r, g, b, a,
       CAST(CAST(floor(r / 255.0e0 * 255.0e0) AS BIGINT) | (CAST(floor(g / 255.0e0 * 255.0e0) AS BIGINT) << 8)
            | (CAST(floor(b / 255.0e0 * 255.0e0) AS BIGINT) << 16) | (255::BIGINT << 24) AS BIGINT) - 4294967296 AS px_unit
FROM c""")
def q_x1_channels(spark, d):
    """X1 unpack, X5 to [0,1] and back (alpha 255), X2 pack."""
    from .functions import pixels as px
    p = tb.pixels_from_lineitem(spark, d)
    return p.select("image_id", "x", "y", px.red("px").alias("r"), px.green("px").alias("g"),
                    px.blue("px").alias("b"), px.alpha("px").alias("a"),
                    px.from_unit(px.to_unit("px")).cast("long").alias("px_unit"))


@register("x4_stretch", PX_SQL + """,
m AS (SELECT *, greatest(r, g, b) AS hi, least(r, g, b) AS lo FROM c),
s AS (SELECT image_id, x, y, px, hi, lo,
        CAST(floor(255 * (r - lo) / CAST(hi - lo AS DOUBLE)) AS BIGINT) AS nr,
        CAST(floor(255 * (g - lo) / CAST(hi - lo AS DOUBLE)) AS BIGINT) AS ng,
        CAST(floor(255 * (b - lo) / CAST(hi - lo AS DOUBLE)) AS BIGINT) AS nb
      FROM m WHERE hi <> lo)
SELECT image_id, x, y, CAST(nr | (ng << 8) | (nb << 16) | (255::BIGINT << 24) AS BIGINT) - 4294967296 AS px FROM s
UNION ALL
SELECT image_id, x, y, CAST(px AS BIGINT) FROM m WHERE hi = lo""")
def q_x4_stretch(spark, d):
    """X3 max/min, X4 stretch over every lineitem pixel."""
    from .operators.pixels import stretch_pixels
    p = stretch_pixels(tb.pixels_from_lineitem(spark, d))
    return p.select("image_id", "x", "y", F.col("px").cast("long").alias("px"))


@register("x6_pixel_count", """
SELECT l_orderkey AS image_id, COUNT(*) AS n_pixels FROM lineitem GROUP BY 1""")
def q_x6_pixel_count(spark, d):
    from .operators.pixels import pixel_counts
    return pixel_counts(tb.pixels_from_lineitem(spark, d))


@register("s8_image_round_trip", PX_SQL + """,
t AS (SELECT image_id // 64 AS tile, CAST(x - 1 AS INT) AS col, CAST(image_id % 64 AS INT) AS row, MAX(px) AS px FROM p GROUP BY 1, 2, 3),
s AS (SELECT tile, MAX(col) + 1 AS w, MAX(row) + 1 AS h FROM t GROUP BY tile),
a AS (SELECT tile, row, unnest(range(w)) AS col FROM (SELECT tile, w, unnest(range(h)) AS row FROM s))
SELECT CAST(a.tile AS VARCHAR) AS image_id, CAST(a.col AS INT) AS x, CAST(a.row AS INT) AS y, coalesce(t.px, 0) AS px
FROM a LEFT JOIN t ON t.tile = a.tile AND t.row = a.row AND t.col = a.col""")
def q_s8_image_round_trip(spark, d):
    """The lineitem pixels in PNG files, one for 64 orders (a line per order; of several pixels in a cell the largest), written
    and read as an image folder."""
    from .session import scratch_path
    from .sources.images import read_pixels, write_pixels, written_id
    p = tb.pixels_from_lineitem(spark, d)
    path = scratch_path(spark, "images")
    write_pixels(p.select(F.floor(F.col("image_id") / 64).alias("image_id"), (F.col("x") - 1).alias("x"), (F.col("image_id") % 64).alias("y"), "px"), path)
    return read_pixels(spark, path + "/*").select(written_id().alias("image_id"), "x", "y", "px")


# ------------------------------------------------------------------ trainers run to their own stop test
#: What both engines can say of a run whose steps depend on the data: sizes from the tables; that the loss of the
#: returned point, summed again by A5, is the last of a trace that never rises; and, from the trace alone (W1), that
#: the run went on exactly until its own test at the default bound was met, so that an early stop shows.
EPS = 0.001
INVARIANT_SQL = with_sql(R_EV_SQL) + """SELECT '{name}' AS trainer, MAX("user") + 1 AS n_users, MAX(item) + 1 AS n_items, 10 AS rank,
       true AS ended_by_its_test, true AS never_rises, true AS loss_is_true, true AS better_than_start FROM r"""


def _ev_problem(spark, d, rank):
    from .operators.params import init_params
    from .plans.descent import Problem
    from .session import cut
    r = cut(_r_ev(spark, d))
    dm = rt.dims(r)
    return Problem(r, rank, LAM, float(dm.n_ratings)), init_params(spark, dm.n_users, dm.n_items, rank, 8, 0.5)


def _invariants(spark, name, prob, x0, fit, ended):
    losses = [row["loss"] for row in fit.trace.rows]
    loss = lambda p: objective.loss(prob.ratings, p.uf, p.vf, prob.k, prob.lam, prob.normalizer)
    end, start = loss(fit.params), loss(x0)
    sizes = [f.agg(F.max("id")).first()[0] + 1 for f in fit.params.sides()]
    return spark.createDataFrame([(name, *sizes, rc.factor_rank(fit.params.vf), bool(ended),
                                   all(b <= a * (1 + 1e-9) for a, b in zip(losses, losses[1:])),
                                   abs(end - losses[-1]) <= 1e-9 * max(1.0, end), end < start)],
                                 "trainer string, n_users long, n_items long, rank int, ended_by_its_test boolean, never_rises boolean, "
                                 "loss_is_true boolean, better_than_start boolean")


def _shrinks(spark, fit, window=10):
    """W1 of the trace by its own operator, oldest first."""
    from .operators.diagnostics import shrink
    return [r["shrink"] for r in shrink(fit.trace.frame(spark).select("iter", "red"), window).orderBy("iter").collect()]


@register("m1_als_builtin", with_sql(R_EV_SQL) + """
SELECT 'user' AS side, MAX("user") + 1 AS n_ids, 10 AS rank, true AS non_negative, true AS any_positive, COUNT(DISTINCT "user") AS n_rated,
       0 AS n_violating FROM r
UNION ALL SELECT 'item', MAX(item) + 1, 10, true, true, COUNT(DISTINCT item), 0 FROM r""")
def q_m1_als_builtin(spark, d):
    """Library ALS (rank 10, 20 iterations, λ 0.01, non-negative, seed 8) on r_ev, with its optimality certificate.

    The users were solved last: each meets the conditions of its non-negative least squares up to the rounding of
    single-precision factors.  The items were solved one half-step before; that moved the users a little once more, so
    theirs hold up to what a half-step still moves after 20 iterations.
    """
    from .operators.optimality import nnls_violations
    from .plans.als import fit_als_builtin
    r = _r_ev(spark, d)
    x = fit_als_builtin(r, rank=10, lam=LAM)

    def side(name, other, f, g, tolerance):
        far = nnls_violations(r, f, g, name, other, 10, LAM)
        counts = far.agg(F.count(F.lit(1)).alias("n_rated"), F.count_if(~(F.col("violation") <= tolerance * F.col("scale"))).alias("n_violating"))
        return f.agg(F.count(F.lit(1)).alias("n_ids"), F.max(F.size("features")).alias("rank"),
                     (F.min(F.array_min("features")) >= 0).alias("non_negative"),
                     (F.max(F.array_max("features")) > 0).alias("any_positive")).select(F.lit(name).alias("side"), "*").join(F.broadcast(counts))
    return side("user", "item", x.uf, x.vf, ROUNDING).unionByName(side("item", "user", x.vf, x.uf, LAST_MOVE))


#: Violations relative to the sums they are made of: single-precision factors, and what the last half-step moves.
ROUNDING, LAST_MOVE = 1e-5, 0.05


@register("m4_gd_fixed_to_its_test", with_sql(R_ORD_SQL, DET_SQL) + """
SELECT 'm4' AS trainer, COUNT(*) AS n_ratings, true AS converged, true AS last_change_within, true AS changes_before_beyond,
       true AS loss_is_true FROM r""")
def q_m4_gd_fixed_to_its_test(spark, d):
    """Fixed steps (a = 100) from the deterministic point until the loss changes by ε = 0.001 at most."""
    from .operators.params import Params
    from .plans.descent import Problem, fit_gd_fixed
    r = _r_ord_once(spark, d)
    uf, vf = _det_once(r)
    n = r.count()
    fit = fit_gd_fixed(Problem(r, 2, LAM, float(n)), Params(uf, vf), GD_STEP, EPS)
    losses = [row["loss"] for row in fit.trace.rows]
    end = objective.loss(r, fit.params.uf, fit.params.vf, 2, LAM, float(n))
    drop_all(r, uf, vf, fit.params.whole)
    return spark.createDataFrame([("m4", n, fit.converged, abs(losses[-1] - end) <= EPS,
                                   all(abs(a - b) > EPS for a, b in zip(losses, losses[1:])), end < losses[-1])],
                                 "trainer string, n_ratings long, converged boolean, last_change_within boolean, "
                                 "changes_before_beyond boolean, loss_is_true boolean")


@register("m5_gd_adaptive", INVARIANT_SQL.format(name="m5"))
def q_m5_gd_adaptive(spark, d):
    """Adaptive descent at rank 10 until the shrink rate falls below 0.001: below it at the end, at no point before."""
    from .plans.descent import fit_gd_adaptive
    prob, x0 = _ev_problem(spark, d, 10)
    fit = fit_gd_adaptive(prob, x0, 50.0, EPS)
    s = _shrinks(spark, fit)
    return _invariants(spark, "m5", prob, x0, fit, fit.converged and s[-1] < EPS <= min(s[:-1]))


@register("m6_gd_linesearch", INVARIANT_SQL.format(name="m6"))
def q_m6_gd_linesearch(spark, d):
    """Descent with line search at rank 10 until the shrink rate falls below 0.001 (tested before an improving step, which is taken)."""
    from .plans.descent import fit_gd_linesearch
    prob, x0 = _ev_problem(spark, d, 10)
    fit = fit_gd_linesearch(prob, x0, EPS)
    return _invariants(spark, "m6", prob, x0, fit, fit.converged and _shrinks(spark, fit)[-2] < EPS)


@register("m7_cg", INVARIANT_SQL.format(name="m7"))
def q_m7_cg(spark, d):
    """Conjugate gradients at rank 10 over their default length, bounded by nothing else."""
    from .plans.descent import CG_LENGTH, fit_cg
    prob, x0 = _ev_problem(spark, d, 10)
    fit = fit_cg(prob, x0)
    searches = len(fit.trace.rows) - 1
    return _invariants(spark, "m7", prob, x0, fit, fit.converged or CG_LENGTH // 2 <= searches <= CG_LENGTH)


@register("f7_guards", with_sql(R_ORD_SQL) + """
SELECT c AS case_, COUNT(*) AS n_ratings, o AS converged, true AS finite FROM r, (VALUES
  ('line search at an optimum', true), ('conjugate gradients at an optimum', true), ('fixed step at an optimum', true),
  ('fixed step that diverges', false)) v(c, o) GROUP BY c, o""")
def q_f7_guards(spark, d):
    """Starts at an exact optimum (the ratings are its predictions, λ = 0) and a step that diverges: all end, none raises."""
    from .operators.blocks import RatingBlocks
    from .operators.params import Params
    from .plans.descent import Problem, fit_cg, fit_gd_fixed, fit_gd_linesearch
    from .session import cut
    r = _r_ord_once(spark, d)
    uf, vf = _det_once(r)
    exact = cut(rt.predict(r, uf, vf, 2).select("user", "item", F.col("pred").alias("rating")))
    n = float(exact.count())
    blocks = RatingBlocks.of(exact, sides=("grid",))  # one layout for the three runs over the same ratings
    at = lambda: (Problem(exact, 2, 0.0, n, blocks, shared=True), Params(uf, vf))
    fits = {"line search at an optimum": fit_gd_linesearch(*at()), "conjugate gradients at an optimum": fit_cg(*at()),
            "fixed step at an optimum": fit_gd_fixed(*at(), 100.0, EPS)}
    blocks.release()
    fits["fixed step that diverges"] = fit_gd_fixed(Problem(r, 2, LAM, n), Params(uf, vf), 1e9, EPS)
    rows = [(name, int(n), fit.converged, all(row["loss"] == row["loss"] and row["loss"] < float("inf") for row in fit.trace.rows))
            for name, fit in fits.items()]
    return spark.createDataFrame(rows, "case_ string, n_ratings long, converged boolean, finite boolean")


@register("m10_fit_own_als", with_sql(R_EV_SQL) + """
SELECT MAX("user") + 1 AS n_users, MAX(item) + 1 AS n_items, 10 AS rank, 3 AS trainer, true AS converged,
       COUNT(*) AS n_seen, true AS fits FROM r""")
def q_m10_fit(spark, d):
    """Trainer 3 (own ALS, rank 10, ε 0.001, λ 0.01) through the dispatch; it explains most of the ratings' variance."""
    from .plans.model import TRAINER_OWN_ALS, fit
    r = _r_ev(spark, d)
    m = fit(r, tb.items_from_parts(spark, d), TRAINER_OWN_ALS)
    e = rt.residuals(r, m.user_factors, m.item_factors, m.rank)
    return e.agg(F.count(F.lit(1)).alias("n_seen"), (F.avg(F.col("resid") * F.col("resid")) < 0.5 * F.var_pop("rating")).alias("fits")).select(
        F.lit(m.meta["n_users"]).cast("long").alias("n_users"), F.lit(m.meta["n_items"]).cast("long").alias("n_items"),
        F.lit(m.rank).alias("rank"), F.lit(m.meta["trainer"]).alias("trainer"), F.lit(m.meta["converged"]).alias("converged"),
        "n_seen", "fits")


@register("d5_compare_trainers", with_sql(R_EV_SQL) + """
SELECT t AS trainer, true AS below_start, true AS above_zero, COUNT(*) AS n_ratings
FROM r, (VALUES ('start'), ('own_als'), ('gd_linesearch')) v(t) GROUP BY t""")
def q_d5_compare(spark, d):
    """Losses of own ALS and of descent with line search (rank 10, to their stop tests) and of their common start."""
    from .operators.diagnostics import compare_trainers
    from .plans.als import fit_als
    from .plans.descent import fit_gd_linesearch
    prob, x0 = _ev_problem(spark, d, 10)
    fits = {"start": x0, "own_als": fit_als(prob.ratings, rank=10, lam=LAM, init=x0).params,
            "gd_linesearch": fit_gd_linesearch(prob, x0, EPS).params}
    losses = compare_trainers(prob.ratings, fits, 10, LAM, prob.normalizer)
    first = losses.filter("trainer = 'start'").first()["loss"]
    return losses.select(
        "trainer", ((F.col("loss") < first) | (F.col("trainer") == "start")).alias("below_start"),
        (F.col("loss") > 0).alias("above_zero"), F.lit(int(prob.normalizer)).cast("long").alias("n_ratings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
