"""Axis generation, bounds, cropping and scalar functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridloom.functions import projection
from gridloom.functions.columns import (
    calendar_fields, cell_area, clip_negative, greater, isclose, less, mass_mixing_ratio, search_distance, sentinel, wrap_lon, year_of,
)
from gridloom.functions.legends import decode, flag_table
from gridloom.operators import merge as mg
from gridloom.operators import regrid
from gridloom.sinks.writers import coerce, emission_attributes, emissions, valid_range
from gridloom.sources import axes as ax
from gridloom.sources import fields as fl
from workload.fixtures import AXES, GASES, MONTHLY, MONTH_AXES, RASTER, axes, gases, grid, month_axes, monthly, raster, read
from workload.registry import query

R = 6371229.0


@query(
    "sc8_regular_grid",
    f"""WITH {RASTER}, gy AS (SELECT i AS y, least(greatest(90 - (i * 1.0::DOUBLE) * (180.0::DOUBLE / ny), -90), 90) AS a,
  least(greatest(90 - (i + 1.0::DOUBLE) * (180.0::DOUBLE / ny), -90), 90) AS b FROM dims, range((SELECT ny FROM dims)) r(i))
SELECT r.y, r.x, round(90 - (r.y + 0.5) * 180 / ny, 6) AS lat, round((x + 0.5) * 360 / nx, 6) AS lon, round(a, 6) AS y_lo, round(b, 6) AS y_hi, price
FROM raster r JOIN gy ON gy.y = r.y""",
)
def regular_grid(spark, sf):
    g = grid(spark, sf)
    y, x = ax.regular_grid(spark, nx=g.nx, ny=g.ny, north_first=True)
    cells = ax.grid_cells(y, x, g.nx).join(raster(spark, sf, g).select("y", "x", "price"), ["y", "x"])
    return cells.select("y", "x", *[F.round(c, 6).alias(c) for c in ("lat", "lon", "y_lo", "y_hi")], "price")


PARTS = """pts AS (SELECT o_custkey AS cust, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INT) AS idx,
  CAST(o_orderkey AS DOUBLE) AS point FROM orders)"""


@query(
    "sc9_variable_grid",
    f"""WITH {PARTS}, mids AS (SELECT *, (lag(point) OVER w + point) / 2 AS lo, (point + lead(point) OVER w) / 2 AS hi FROM pts
  WINDOW w AS (PARTITION BY cust ORDER BY idx))
SELECT cust, idx, point, coalesce(lo, 2 * point - hi) AS lo, coalesce(hi, 2 * point - lo) AS hi FROM mids WHERE lo IS NOT NULL OR hi IS NOT NULL""",
)
def variable_grid(spark, sf):
    p = customer_axis(spark, sf)
    w = Window.partitionBy("cust").orderBy("idx")
    edges = p.select("cust", "idx", ((F.col("point") + F.lead("point").over(w)) / 2).alias("point")).filter("point IS NOT NULL")
    return ax.variable_axis(p, edges, ["cust"])


@query(
    "sc10_hybrid_levels",
    """WITH e AS (SELECT o_custkey AS cust, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS idx,
    o_totalprice / max(o_totalprice) OVER (PARTITION BY o_custkey) AS eta FROM orders),
theta AS (SELECT cust, idx, eta FROM e UNION ALL SELECT DISTINCT cust, 0, 0.0::DOUBLE FROM e),
lv AS (SELECT *, (eta + coalesce(lag(eta) OVER w, 0)) / 2 AS er FROM theta WINDOW w AS (PARTITION BY cust ORDER BY idx)),
r AS (SELECT l.*, k.er AS ref, 40000 * l.eta AS h, 40000 * l.er AS hl FROM lv l JOIN lv k ON k.cust = l.cust AND k.idx = 3),
s AS (SELECT *, CASE WHEN idx < 3 THEN pow(1 - eta / ref, 2) ELSE 0 END AS sg, CASE WHEN idx < 3 THEN pow(1 - er / ref, 2) ELSE 0 END AS sl FROM r),
b AS (SELECT *, coalesce(lead(hl) OVER w, 2 * h - hl) AS hh, coalesce(lead(sl) OVER w, 0) AS sh,
  CASE WHEN idx = 1 THEN lag(hl) OVER w ELSE hl END AS hlo, CASE WHEN idx = 1 THEN lag(sl) OVER w ELSE sl END AS slo,
  coalesce(h >= lag(h) OVER w, true) AND coalesce(sg <= lag(sg) OVER w, true) AS mono FROM s WINDOW w AS (PARTITION BY cust ORDER BY idx))
SELECT cust, CAST(idx AS INT) AS level, round(h, 5) AS height, round(hlo, 5) AS height_lo, round(hh, 5) AS height_hi,
  round(sg, 7) AS sigma, round(slo, 7) AS sigma_lo, round(sh, 7) AS sigma_hi, mono AS monotonic FROM b WHERE idx > 0""",
)
def hybrid_levels(spark, sf):
    w = Window.partitionBy("o_custkey")
    o = read(spark, sf, "orders").select(
        F.col("o_custkey").alias("cust"), F.row_number().over(w.orderBy("o_totalprice", "o_orderkey")).alias("idx"),
        (F.col("o_totalprice") / F.max("o_totalprice").over(w)).alias("eta"),
    )
    theta = o.unionByName(o.select("cust").distinct().select("cust", F.lit(0).alias("idx"), F.lit(0.0).alias("eta")))
    before = F.coalesce(F.lag("eta").over(Window.partitionBy("cust").orderBy("idx")), F.lit(0.0))
    rho = theta.select("cust", "idx", ((F.col("eta") + before) / 2).alias("eta")).filter("idx > 0")
    out = ax.hybrid_levels(theta, rho, 40000.0, 3, ["cust"])
    return out.select(
        "cust", "level", *[F.round(c, 5).alias(c) for c in ("height", "height_lo", "height_hi")],
        *[F.round(c, 7).alias(c) for c in ("sigma", "sigma_lo", "sigma_hi")], "monotonic",
    )


@query(
    "wn11_guess_bounds",
    """WITH p AS (SELECT o_custkey AS cust, CAST(row_number() OVER w - 1 AS INT) AS idx, CAST(o_orderkey AS DOUBLE) AS point FROM orders
  WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)),
n AS (SELECT *, lag(point) OVER w AS a, lead(point) OVER w AS b FROM p WINDOW w AS (PARTITION BY cust ORDER BY idx))
SELECT cust, idx, point, coalesce((a + point) / 2, point - (b - point) / 2) AS lo, coalesce((b + point) / 2, point + (point - a) / 2) AS hi FROM n""",
)
def guess_bounds(spark, sf):
    return ax.guess_bounds(customer_axis(spark, sf), ["cust"])


def customer_axis(spark, sf):
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    return read(spark, sf, "orders").select(
        F.col("o_custkey").alias("cust"), (F.row_number().over(w) - 1).alias("idx"), F.col("o_orderkey").cast("double").alias("point")
    )


@query(
    "pf22_outer_bounds",
    """WITH p AS (SELECT o_custkey AS cust, CAST(row_number() OVER w - 1 AS INT) AS idx, CAST(o_orderkey AS DOUBLE) AS point FROM orders
  WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)),
n AS (SELECT *, lag(point) OVER w AS a, lead(point) OVER w AS b FROM p WINDOW w AS (PARTITION BY cust ORDER BY idx))
SELECT cust, idx, point, CASE WHEN a IS NULL THEN -1.0::DOUBLE ELSE (a + point) / 2 END AS lo,
  CASE WHEN b IS NULL THEN 1e9::DOUBLE ELSE (b + point) / 2 END AS hi FROM n""",
)
def outer_bounds(spark, sf):
    return ax.set_outer_bounds(ax.guess_bounds(customer_axis(spark, sf), ["cust"]), -1.0, 1e9, ["cust"])


FIELD_AXES = f"""{MONTHLY}, {MONTH_AXES}, fx AS (SELECT DISTINCT field_id, x FROM monthly),
e AS (SELECT field_id, min(lo) AS lo, max(hi) AS hi, count(*) AS n FROM fx JOIN mx ON mx.idx = fx.x GROUP BY field_id)"""


def field_axes(spark, sf):
    x = monthly(spark, sf).select("field_id", F.col("x").alias("idx")).distinct()
    return x.join(month_axes(spark)[1], "idx")


@query("ag4_extent", f"WITH {FIELD_AXES} SELECT field_id, lo, hi, n FROM e")
def extent(spark, sf):
    return ax.extent(field_axes(spark, sf), ["field_id"])


@query("pf15_is_global", f"WITH {FIELD_AXES} SELECT field_id, abs(hi - lo - 360) <= 1e-10 + 1e-5 * 360 AS is_global FROM e")
def is_global(spark, sf):
    return ax.covers(field_axes(spark, sf), 360.0, ["field_id"]).select("field_id", "is_global")


@query(
    "sc1_circular_flag",
    f"WITH {FIELD_AXES} SELECT f.field_id, x AS idx, abs(hi - lo - 360) <= 1e-10 + 1e-5 * 360 AS circular FROM fx f JOIN e ON e.field_id = f.field_id",
)
def circular_flag(spark, sf):
    return fl.with_circular_flag(field_axes(spark, sf), ["field_id"]).select("field_id", "idx", "circular")


@query(
    "pf3_overlapping_indices",
    """WITH p AS (SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS idx, p_size AS w, sum(p_size) OVER () AS total FROM part),
a AS (SELECT idx, -180 + 360 * (sum(w) OVER (ORDER BY idx) - w) / total::DOUBLE AS lo, -180 + 360 * sum(w) OVER (ORDER BY idx) / total::DOUBLE AS hi FROM p),
hit AS (SELECT idx FROM a, (SELECT unnest([-360, 0, 360]) AS k) WHERE lo + k < 200 - 1e-10 AND hi + k > 150 + 1e-10), n AS (SELECT count(*) AS n FROM a)
SELECT DISTINCT CAST((idx + d + n) % n AS INT) AS idx FROM hit, n, (SELECT unnest([-2, -1, 0, 1, 2]) AS d)""",
)
def overlapping_indices(spark, sf):
    """A global axis whose cells are as wide as the parts' sizes."""
    w = Window.orderBy("p_partkey")  # one side of a grid
    p = read(spark, sf, "part").select((F.row_number().over(w) - 1).cast("int").alias("idx"), F.sum("p_size").over(w).alias("s"), "p_size")
    total = p.agg(F.max("s")).first()[0]
    lo, hi = [F.lit(-180.0) + F.lit(360.0) * c / F.lit(float(total)) for c in (F.col("s") - F.col("p_size"), F.col("s"))]
    return ax.overlapping_indices(p.select("idx", ((lo + hi) / 2).alias("point"), lo.alias("lo"), hi.alias("hi")), 150.0, 200.0, 2, 360.0)


@query(
    "pf2_crop_to_target",
    f"""WITH {RASTER}, {AXES}, ys AS (SELECT DISTINCT idx + d AS y FROM ay, (SELECT unnest([-1, 0, 1]) AS d) WHERE lo < 55 AND hi > 10),
xs AS (SELECT DISTINCT (idx + d + nx) % nx AS x FROM ax, dims, (SELECT unnest([-1, 0, 1]) AS d), (SELECT unnest([-360, 0, 360]) AS k)
  WHERE lo + k < -150 AND hi + k > -210)
SELECT y, x, price FROM raster WHERE y IN (SELECT y FROM ys) AND x IN (SELECT x FROM xs)""",
)
def crop_to_target(spark, sf):
    g = grid(spark, sf)
    ty, tx = ax.regular_axis(spark, 9, 10.0, 5.0), ax.regular_axis(spark, 12, -210.0, 5.0)
    return mg.crop(raster(spark, sf, g).select("y", "x", "price"), *axes(spark, g), ty, tx)


@query(
    "pf4_contiguous_runs",
    """SELECT status, min(k) AS first, max(k) AS last, count(*) AS size FROM (
  SELECT o_orderstatus AS status, o_orderkey AS k, o_orderkey - row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS g FROM orders)
GROUP BY status, g""",
)
def contiguous_runs(spark, sf):
    o = read(spark, sf, "orders").select(F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("k"))
    return ax.contiguous_runs(o, ["status"], "k")


@query(
    "pf6_tolerant_predicates",
    """SELECT l_returnflag, count(*) FILTER (l_quantity > 25 - 1e-10) AS n_greater, count(*) FILTER (l_quantity < 25 + 1e-10) AS n_less,
  count(*) FILTER (abs(l_extendedprice - l_extendedprice * (1 + l_tax / 5000)) <= 1e-10 + 1e-5 * abs(l_extendedprice * (1 + l_tax / 5000))) AS n_close,
  count(*) FILTER (round(l_extendedprice, 10) IN (SELECT round(p_retailprice, 10) FROM part)) AS n_in
FROM lineitem GROUP BY l_returnflag""",
)
def tolerant_predicates(spark, sf):
    li, q = read(spark, sf, "lineitem"), F.col("l_quantity")
    e = F.col("l_extendedprice")
    return mg.within_tolerance(li, "l_extendedprice", read(spark, sf, "part"), "p_retailprice").groupBy("l_returnflag").agg(
        F.count_if(greater(q, F.lit(25.0))).alias("n_greater"), F.count_if(less(q, F.lit(25.0))).alias("n_less"),
        F.count_if(isclose(e, e * (1 + F.col("l_tax") / 5000))).alias("n_close"), F.count_if("hit").alias("n_in"),
    )


@query("so1_reverse_axis", f"WITH {RASTER} SELECT CAST(ny - 1 - y AS INT) AS y, x, price, round(-(-90 + (y + 0.5) * 180 / ny), 6) AS lat FROM raster")
def reverse_axis(spark, sf):
    g = grid(spark, sf)
    y = ax.regular_axis(spark, g.ny, 90.0, -180.0 / g.ny)
    back = ax.reverse(y, g.ny).select((F.lit(g.ny - 1) - F.col("idx")).alias("old"), F.col("idx").alias("y2"), F.round("point", 6).alias("lat"))
    r = raster(spark, sf, g).select("y", "x", "price")
    return r.join(back, r["y"] == back["old"]).select(F.col("y2").alias("y"), "x", "price", "lat")


@query(
    "so2_ascending_latitude",
    f"WITH {PARTS} SELECT cust, CAST(row_number() OVER (PARTITION BY cust ORDER BY -point) - 1 AS INT) AS idx, -point AS point FROM pts",
)
def ascending_latitude(spark, sf):
    return ax.ascending(customer_axis(spark, sf).withColumn("point", -F.col("point")), ["cust"])


@query("so2_ascending_cells", f"WITH {RASTER} SELECT CAST(ny - 1 - y AS INT) AS y, x, price FROM raster")
def ascending_cells(spark, sf):
    g = grid(spark, sf)
    return ax.ascending_cells(raster(spark, sf, g).select("y", "x", "price"), ax.reverse(axes(spark, g)[0], g.ny))


@query(
    "so5_seed_index",
    f"""WITH {RASTER}, {AXES}, seeds AS (SELECT c_custkey AS id, c_acctbal / 150 AS p FROM customer)
SELECT id, arg_min(idx, (round(abs(point - p), 9), idx)) AS idx FROM seeds, ay
WHERE p BETWEEN (SELECT min(point) FROM ay) AND (SELECT max(point) FROM ay) GROUP BY id""",
)
def seed_index(spark, sf):
    g = grid(spark, sf)
    seeds = read(spark, sf, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_acctbal") / 150).alias("point"))
    return regrid.seed_indices(axes(spark, g)[0], seeds, strict=False)


@query(
    "st1_union_axes",
    """WITH a AS (SELECT o_custkey AS cust, CAST(o_orderkey AS DOUBLE) AS point FROM orders WHERE o_orderstatus <> 'P'),
u AS (SELECT cust, point FROM a UNION SELECT cust, max(point) + k FROM a, (SELECT unnest([0.0, 1.5, 3.0]) AS k) GROUP BY cust, k)
SELECT cust, CAST(row_number() OVER (PARTITION BY cust ORDER BY point) - 1 AS INT) AS idx, point FROM u""",
)
def union_axes(spark, sf):
    a = read(spark, sf, "orders").filter("o_orderstatus <> 'P'").select(F.col("o_custkey").alias("cust"), F.col("o_orderkey").cast("double").alias("point"))
    b = a.groupBy("cust").agg(F.max("point").alias("m")).select("cust", F.explode(F.array(*[F.col("m") + k for k in (0.0, 1.5, 3.0)])).alias("point"))
    return ax.union_axes(a, b, ["cust"])


@query(
    "fn2_wrap_longitude",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN abs(p - 180) <= 1e-10 THEN 180.0::DOUBLE ELSE round(p - 360 * floor((p + 180) / 360), 6) END AS lon
FROM (SELECT *, l_extendedprice / 50 - 270 * (l_linenumber % 3) AS p FROM lineitem)""",
)
def wrap_longitude(spark, sf):
    p = F.col("l_extendedprice") / 50 - 270 * (F.col("l_linenumber") % 3)
    w = wrap_lon(p, -180.0)
    return read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(w, 6).alias("lon"))


@query(
    "fn3_calendar_fields",
    """SELECT o_orderkey, 2000 + o_orderkey // 360 AS y360, o_orderkey % 360 // 30 + 1 AS m360, o_orderkey % 30 + 1 AS d360,
  year(d) + o_orderkey // 365 - 1 AS y365, month(d) AS m365, day(d) AS d365
FROM (SELECT o_orderkey, DATE '2001-01-01' + CAST(o_orderkey % 365 AS INT) AS d FROM orders)""",
)
def calendar(spark, sf):
    days = F.col("o_orderkey") + F.lit(0.25)
    a, b = calendar_fields(days, "360_day", 2000), calendar_fields(days, "365_day", 2000)
    o = read(spark, sf, "orders").select("o_orderkey", a.alias("a"), b.alias("b"))
    return o.select(
        "o_orderkey", *[F.col(f"a.{f}").alias(n + "360") for f, n in (("year", "y"), ("month", "m"), ("day", "d"))],
        *[F.col(f"b.{f}").alias(n + "365") for f, n in (("year", "y"), ("month", "m"), ("day", "d"))],
    )


@query(
    "fn4_year_of_time",
    "SELECT o_orderkey, CAST(floor((o_orderkey + 0.5) / 365.24) AS INT) AS hist, CAST(floor(1850 + (o_orderkey + 0.5) / 365) AS INT) AS scen FROM orders",
)
def year_of_time(spark, sf):
    d = F.col("o_orderkey") + 0.5
    return read(spark, sf, "orders").select("o_orderkey", year_of(d, "historical").alias("hist"), year_of(d, "scenario").alias("scen"))


@query(
    "fn5_rotated_pole",
    f"""WITH {RASTER}, {AXES}, p AS (SELECT r.y, r.x, radians(ay.point) AS phi, radians(ax.point + 2.5) AS lam, radians(37.5) AS th
  FROM raster r JOIN ay ON ay.idx = r.y JOIN ax ON ax.idx = r.x)
SELECT y, x, round(degrees(asin(least(greatest(sin(phi) * sin(th) - cos(phi) * cos(lam) * cos(th), -1), 1))), 5) AS rlat,
  round(degrees(atan2(cos(phi) * sin(lam), cos(phi) * cos(lam) * sin(th) + sin(phi) * cos(th))), 5) AS rlon FROM p""",
)
def rotated_pole(spark, sf):
    p = located(spark, sf)
    rlat, rlon = projection.to_rotated(F.col("lat"), F.col("lon"), 37.5, 177.5)
    return p.select("y", "x", F.round(rlat, 5).alias("rlat"), F.round(rlon, 5).alias("rlon"))


def located(spark, sf):
    g = grid(spark, sf)
    ay, axx = axes(spark, g)
    ya, xa = ay.select(F.col("idx").alias("y"), F.col("point").alias("lat")), axx.select(F.col("idx").alias("x"), F.col("point").alias("lon"))
    return raster(spark, sf, g).join(ya, "y").join(xa, "x")


@query("fn5_rotated_round_trip", f"WITH {RASTER} SELECT y, x, true AS back FROM raster")
def rotated_round_trip(spark, sf):
    p = located(spark, sf)
    rlat, rlon = projection.to_rotated(F.col("lat"), F.col("lon"), 37.5, 177.5)
    p = p.withColumn("rlat", rlat).withColumn("rlon", rlon)
    lat, lon = projection.from_rotated(F.col("rlat"), F.col("rlon"), 37.5, 177.5)
    back = (F.abs(lat - F.col("lat")) < 1e-6) & (F.abs(lon - F.col("lon")) < 1e-6)
    return p.select("y", "x", back.alias("back"))


@query("fn5_british_round_trip", """SELECT c_custkey, round(100 + (c_acctbal + 1000) * 100, 1) AS northing, round(c_custkey % 700 * 1000.0::DOUBLE + 37.2, 1) AS easting FROM customer""")
def british_round_trip(spark, sf):
    n, e = 100 + (F.col("c_acctbal") + 1000) * 100, F.col("c_custkey") % 700 * 1000.0 + 37.2
    there = read(spark, sf, "customer").select("c_custkey", *[c.alias(k) for c, k in zip(projection.from_british_grid(e, n), ("lat", "lon"))])
    east, north = projection.to_british_grid(F.col("lat"), F.col("lon"))
    return there.select("c_custkey", F.round(north, 1).alias("northing"), F.round(east, 1).alias("easting"))


TM = """SELECT c_custkey, phi, lam, 6377563.396::DOUBLE AS a, 6356256.909::DOUBLE AS b, 0.9996012717::DOUBLE AS f0 FROM (
  SELECT c_custkey, radians(49.5 + (c_acctbal + 1000) / 1100.0) AS phi, radians(CAST(-6 + c_custkey % 80 / 10.0 AS DOUBLE)) AS lam FROM customer)"""


@query(
    "fn5_british_grid",
    f"""WITH p AS ({TM}), q AS (SELECT *, 1 - (b / a) ** 2 AS e2, (a - b) / (a + b) AS n, phi - radians(49.0::DOUBLE) AS d, phi + radians(49.0::DOUBLE) AS s, lam - radians(-2.0::DOUBLE) AS dl,
  sin(phi) AS sp, cos(phi) AS c, tan(phi) ** 2 AS t2 FROM p),
r AS (SELECT *, a * f0 / sqrt(1 - e2 * sp * sp) AS nu, a * f0 / sqrt(1 - e2 * sp * sp) * (1 - e2) / (1 - e2 * sp * sp) AS rho,
  b * f0 * ((1 + n + 1.25::DOUBLE * n ** 2 + 1.25::DOUBLE * n ** 3) * d - (3 * n + 3 * n ** 2 + 2.625::DOUBLE * n ** 3) * sin(d) * cos(s)
   + 1.875::DOUBLE * (n ** 2 + n ** 3) * sin(2 * d) * cos(2 * s) - 35 / 24.0::DOUBLE * n ** 3 * sin(3 * d) * cos(3 * s)) AS m FROM q),
t AS (SELECT *, nu / rho - 1 AS h2 FROM r)
SELECT c_custkey, round(400000 + nu * c * dl + nu / 6 * c ** 3 * (nu / rho - t2) * dl ** 3
  + nu / 120 * c ** 5 * (5 - 18 * t2 + t2 * t2 + 14 * h2 - 58 * t2 * h2) * dl ** 5, 2) AS easting,
 round(m - 100000 + nu / 2 * sp * c * dl ** 2 + nu / 24 * sp * c ** 3 * (5 - t2 + 9 * h2) * dl ** 4
  + nu / 720 * sp * c ** 5 * (61 - 58 * t2 + t2 * t2) * dl ** 6, 2) AS northing FROM t""",
)
def british_grid(spark, sf):
    lat = 49.5 + (F.col("c_acctbal") + 1000) / 1100.0
    lon = -6 + F.col("c_custkey") % 80 / 10.0
    e, n = projection.to_british_grid(lat, lon)
    return read(spark, sf, "customer").select("c_custkey", F.round(e, 2).alias("easting"), F.round(n, 2).alias("northing"))


@query(
    "fn5_bounding_box",
    f"""WITH {RASTER}, {AXES}, p AS (SELECT status, radians(ay.point) AS phi, radians(ax.point + 2.5) AS lam, radians(37.5) AS th
  FROM raster r JOIN ay ON ay.idx = r.y JOIN ax ON ax.idx = r.x)
SELECT status, round(min(u), 4) AS u_min, round(max(u), 4) AS u_max, round(min(v), 4) AS v_min, round(max(v), 4) AS v_max FROM (
 SELECT status, degrees(asin(sin(phi) * sin(th) - cos(phi) * cos(lam) * cos(th))) AS v,
  degrees(atan2(cos(phi) * sin(lam), cos(phi) * cos(lam) * sin(th) + sin(phi) * cos(th))) AS u FROM p) GROUP BY status""",
)
def bounding_box(spark, sf):
    v, u = projection.to_rotated(F.col("lat"), F.col("lon"), 37.5, 177.5)
    b = projection.bounding_box(located(spark, sf), u, v, ["status"])
    return b.select("status", *[F.round(c, 4).alias(c) for c in ("u_min", "u_max", "v_min", "v_max")])


@query(
    "ag12_cell_areas",
    f"""WITH {RASTER} SELECT y, x, round(area / 1e6, 3) AS km2 FROM (
  SELECT y, x, {R}::DOUBLE * {R}::DOUBLE * (sin(radians(-90 + (y + 1) * (180.0::DOUBLE / ny))) - sin(radians(-90 + y * (180.0::DOUBLE / ny)))) * radians(360.0::DOUBLE / nx) AS area FROM raster)""",
)
def cell_areas(spark, sf):
    g = grid(spark, sf)
    dy, dx = 180.0 / g.ny, 360.0 / g.nx
    a = cell_area(F.col("y") * dy - 90, (F.col("y") + 1) * dy - 90, F.lit(0.0), F.lit(dx))
    return raster(spark, sf, g).select("y", "x", F.round(a / 1e6, 3).alias("km2"))


@query(
    "fn7_flag_meanings",
    """SELECT p_partkey, CAST(i AS INT) AS flag_value, lower(m[i]) AS flag_meaning FROM (
  SELECT p_partkey, list_filter(string_split(p_type, ' '), lambda x: x <> '') AS m, unnest(generate_series(1, len(list_filter(string_split(p_type, ' '), lambda x: x <> '')))) AS i FROM part)""",
)
def flag_meanings(spark, sf):
    sep = F.element_at(F.array(F.lit(", "), F.lit(";"), F.lit(":"), F.lit(" ")), (F.col("p_partkey") % 4 + 1).cast("int"))
    p = read(spark, sf, "part").select(
        "p_partkey", F.array_join(F.split("p_type", " "), "|").alias("m"), sep.alias("sep"), F.size(F.split("p_type", " ")).alias("n")
    )
    p = p.select("p_partkey", F.replace("m", F.lit("|"), F.col("sep")).alias("flag_meanings"), F.sequence(F.lit(1), "n").alias("flag_values"))
    return flag_table(p, by=["p_partkey"], strict=False)


@query(
    "fn8_decode_legend",
    f"""WITH {RASTER}, l AS (SELECT unnest(['ocean', 'evergreen_needleleaf_forest', 'evergreen_broadleaf_forest', 'deciduous_needleleaf_forest',
  'deciduous_broadleaf_forest', 'mixed_forest', 'closed_shrublands']) AS flag_meaning, unnest(range(7)) AS code)
SELECT y, x, r.code, flag_meaning FROM raster r JOIN l ON l.code = r.code""",
)
def decode_legend(spark, sf):
    return decode(raster(spark, sf).select("y", "x", "code"), "igbp").select("y", "x", "code", "flag_meaning")


@query(
    "fn9_search_distance",
    "SELECT o_orderkey, CAST(least(greatest(ceil(29.0::DOUBLE / 34 * (o_orderkey % 60) + 3.0::DOUBLE), 3), 32) AS INT) AS d FROM orders",
)
def search_radius(spark, sf):
    return read(spark, sf, "orders").select("o_orderkey", search_distance(F.col("o_orderkey") % 60, 1.0).alias("d"))


@query("pf13_clip_negative", "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS v FROM customer")
def clip(spark, sf):
    return read(spark, sf, "customer").select("c_custkey", clip_negative(F.col("c_acctbal")).alias("v"))


@query(
    "fn1_mass_mixing_ratio",
    f"""WITH {GASES}, f AS (SELECT * FROM (VALUES ('CO2', 1.5188, 1e-6), ('CH4', 0.5523, 1e-9), ('N2O', 1.5188, 1e-9), ('CFC12', 4.1783, 1e-12), ('HFC134A', 3.5219, 1e-12)) t(gas, m, u))
SELECT g.gas, sector, days, round(value * m * u * 1e6, 5) AS mmr FROM gases g JOIN f ON f.gas = g.gas""",
)
def mmr(spark, sf):
    return gases(spark, sf).select("gas", "sector", "days", F.round(mass_mixing_ratio(F.col("gas"), F.col("value")) * 1e6, 5).alias("mmr"))


@query(
    "sk12_sentinel",
    f"WITH {RASTER} SELECT y, x, coalesce(value, -1073741824.0::DOUBLE) AS value FROM raster",
)
def sentinel_values(spark, sf):
    return raster(spark, sf).select("y", "x", sentinel(F.col("value")).alias("value"))


@query("sk1_valid_range", f"WITH {RASTER} SELECT status, CAST(min(value) AS SMALLINT) AS valid_min, CAST(max(value) AS SMALLINT) AS valid_max FROM (SELECT status, trunc(value) AS value FROM raster) GROUP BY status")
def value_range(spark, sf):
    r = raster(spark, sf).select("status", F.col("value").cast("int").cast("double").alias("value"))
    return valid_range(coerce(r, "short"), ["status"])


@query("sk6_emissions", f"WITH {RASTER} SELECT y, x, CAST(coalesce(value, 0) AS FLOAT) AS value FROM raster")
def emission_fields(spark, sf):
    return emissions(raster(spark, sf).select("y", "x", "value"))


@query(
    "sk6_emission_attributes",
    """SELECT p_partkey AS field_id, CASE WHEN p_partkey % 2 = 0 THEN 'update_type' ELSE 'title' END AS name,
  CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS VARCHAR) ELSE p_name END AS text FROM part""",
)
def emission_attribute_table(spark, sf):
    p = read(spark, sf, "part")
    even = F.col("p_partkey") % 2 == 0
    a = p.select(
        F.col("p_partkey").alias("field_id"), F.when(even, "emission_type").otherwise("title").alias("name"),
        F.when(even, F.col("p_size").cast("double").cast("string")).otherwise(F.col("p_name")).alias("text"),
    )
    return emission_attributes(a)
