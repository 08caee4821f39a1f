"""Stencils, gradients, filling, merging, polygons."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.functions.columns import nan
from gridloom.operators import fill as fi
from gridloom.operators import merge as mg
from gridloom.operators import stencil as st
from gridloom.operators.regrid import complete
from gridloom.operators.rivers import coastal
from workload.fixtures import AXES, MONTHLY, RASTER, axes, grid, monthly, raster, read
from workload.registry import query

#: Dense grid: cells beyond the last order are masked.
DENSE = """dense AS (SELECT CAST(i // nx AS INT) AS y, CAST(i % nx AS INT) AS x, r.value, r.code, r.land, r.price, nx, ny
  FROM dims, range((SELECT nx * ny FROM dims)) g(i) LEFT JOIN (SELECT y AS ry, x AS rx, value, code, land, price FROM raster) r
  ON r.ry = i // nx AND r.rx = i % nx)"""
HOOD = """off AS (SELECT dy, dx FROM (SELECT unnest([-1, 0, 1]) AS dy), (SELECT unnest([-1, 0, 1]) AS dx) WHERE dy <> 0 OR dx <> 0),
nb AS (SELECT c.y, c.x, n.value, n.code, n.price, dy, dx FROM dense c, off JOIN dense n ON n.y = c.y + dy AND n.x = (c.x + dx + c.nx) % c.nx)"""


def dense(spark, sf, g, *cols):
    r = raster(spark, sf, g).select("y", "x", *cols)
    return complete(r.withColumn("_p", F.struct(*cols)), g.ny, g.nx, None, "_p").select("y", "x", "_p.*")


@query(
    "wn1_moore_counts",
    f"""WITH {RASTER}, {DENSE}, {HOOD} SELECT y, x, CAST(count(code) AS INT) AS n_valid, count_if(code = 6) = count(code) AS all_equal,
  count_if(code = 6) > 0 AS any_equal FROM nb GROUP BY y, x""",
)
def moore_counts(spark, sf):
    g = grid(spark, sf)
    out = st.neighbourhood(dense(spark, sf, g, "code"), g.nx, value="code", equal_to=6)
    return out.select("y", "x", "n_valid", "all_equal", "any_equal")


@query(
    "wn2_moore_mean",
    f"""WITH {RASTER}, {DENSE}, {HOOD} SELECT y, x, count(value) = 0 AS all_missing, count(value) > 0 AS any_present, round(avg(value), 6) AS mean
FROM nb GROUP BY y, x""",
)
def moore_mean(spark, sf):
    g = grid(spark, sf)
    out = st.neighbourhood(dense(spark, sf, g, "value"), g.nx)
    return out.select("y", "x", "all_missing", "any_present", F.round("mean", 6).alias("mean"))


@query(
    "wn3_open_edges",
    f"""WITH {RASTER}, {DENSE} SELECT c.y, c.x, CAST(count(n.value) AS INT) AS n_valid FROM dense c
LEFT JOIN dense n ON n.y BETWEEN c.y - 2 AND c.y + 2 AND n.x BETWEEN c.x - 1 AND c.x + 1 AND (n.y <> c.y OR n.x <> c.x) GROUP BY c.y, c.x""",
)
def open_edges(spark, sf):
    g = grid(spark, sf)
    return st.neighbourhood(dense(spark, sf, g, "value"), g.nx, circular=False, half=(2, 1)).select("y", "x", "n_valid")


@query(
    "wn1_pattern",
    f"""WITH {RASTER}, {DENSE}, {HOOD} SELECT y, x, coalesce(bool_or((dy = -1 AND dx = 0 AND code = 1) OR (dy = 0 AND dx = 1 AND code = 2) OR (dy = 1 AND dx = -1 AND code = 6)), false) AS any_equal
FROM nb GROUP BY y, x""",
)
def pattern(spark, sf):
    g = grid(spark, sf)
    out = st.any_equal_pattern(dense(spark, sf, g, "code"), {(-1, 0): 1, (0, 1): 2, (1, -1): 6}, g.nx, value="code")
    return out.select("y", "x", "any_equal")


@query(
    "wn4_coastal_fill",
    f"""WITH {RASTER}, {DENSE}, b AS (SELECT * REPLACE (CASE WHEN land = 1 THEN value END AS value) FROM dense),
off AS (SELECT dy, dx FROM (SELECT unnest([-1, 0, 1]) AS dy), (SELECT unnest([-1, 0, 1]) AS dx) WHERE dy <> 0 OR dx <> 0),
m AS (SELECT c.y, c.x, avg(n.value) AS m FROM b c, off JOIN b n ON n.y = c.y + dy AND n.x = (c.x + dx + c.nx) % c.nx GROUP BY c.y, c.x),
f AS (SELECT b.y, b.x, land, b.value, CASE WHEN land = 1 AND b.value IS NULL THEN m ELSE b.value END AS v FROM b JOIN m ON m.y = b.y AND m.x = b.x)
SELECT y, x, round(CASE WHEN land = 1 AND v IS NULL THEN (SELECT avg(v) FROM f) ELSE v END, 5) AS value FROM f""",
)
def coastal_fill(spark, sf):
    g = grid(spark, sf)
    out = st.coastal_fill(dense(spark, sf, g, "value", "land"), "land", g.nx)
    return out.select("y", "x", F.round("value", 5).alias("value"))


@query("ag10_global_mean", f"WITH {RASTER} SELECT land, round(avg(value), 6) AS mean, count(value) AS n FROM raster GROUP BY land")
def global_mean(spark, sf):
    return raster(spark, sf).groupBy("land").agg(F.round(F.avg("value"), 6).alias("mean"), F.count("value").alias("n"))


@query(
    "wn5_gradients",
    f"""WITH {RASTER}, {AXES}, {DENSE}, d AS (SELECT r.y, r.x, coalesce(price, 1000) AS v, nx, ny, radians(ay.point) AS lat, radians(360.0::DOUBLE / nx) AS dl, radians(180.0::DOUBLE / ny) AS dp
    FROM dense r JOIN ay ON ay.idx = r.y),
gx AS (SELECT c.y, c.x, (e.v - w.v) / 2 / dl_ AS g FROM (SELECT *, dl AS dl_ FROM d) c JOIN d e ON e.y = c.y AND e.x = (c.x + 1) % c.nx JOIN d w ON w.y = c.y AND w.x = (c.x + c.nx - 1) % c.nx),
gy AS (SELECT y, x, CASE WHEN y = 0 THEN 1.5 * (v1 - v) - 0.5 * (v2 - v1) WHEN y = ny - 1 THEN 1.5 * (v - u1) - 0.5 * (u1 - u2) ELSE ((v1 - v) + (v - u1)) / 2 END / dp AS g FROM (
  SELECT *, lead(v, 1) OVER w AS v1, lead(v, 2) OVER w AS v2, lag(v, 1) OVER w AS u1, lag(v, 2) OVER w AS u2 FROM d WINDOW w AS (PARTITION BY x ORDER BY y)))
SELECT d.y, d.x, round(gx.g / (6371229.0::DOUBLE * cos(lat)) * 1000, 4) AS dhdx, round(gy.g / 6371229.0::DOUBLE * 1000, 4) AS dhdy
FROM d JOIN gx ON gx.y = d.y AND gx.x = d.x JOIN gy ON gy.y = d.y AND gy.x = d.x""",
)
def gradients(spark, sf):
    g = grid(spark, sf)
    ay, axx = axes(spark, g)
    full = dense(spark, sf, g, "price").select("y", "x", F.coalesce("price", F.lit(1000.0)).alias("price"))
    out = st.gradients(full, ay, axx, value="price")
    return out.select("y", "x", F.round(F.col("dhdx") * 1000, 4).alias("dhdx"), F.round(F.col("dhdy") * 1000, 4).alias("dhdy"))


FLOW = "CASE WHEN price % 11 >= 10 THEN 10 ELSE CAST(floor(price % 11) AS INT) END"


@query(
    "wn6_flow_in",
    f"""WITH {RASTER}, {DENSE}, d AS (SELECT y, x, nx, ny, {FLOW} AS code FROM dense),
t AS (SELECT DISTINCT (y + CASE WHEN code IN (1, 2, 8) THEN -1 WHEN code IN (4, 5, 6) THEN 1 ELSE 0 END + ny) % ny AS y,
  (x + CASE WHEN code IN (2, 3, 4) THEN 1 WHEN code IN (6, 7, 8) THEN -1 ELSE 0 END + nx) % nx AS x FROM d WHERE code BETWEEN 1 AND 8)
SELECT d.y, d.x, d.code, t.y IS NOT NULL AS flow_in FROM d LEFT JOIN t ON t.y = d.y AND t.x = d.x""",
)
def flow_in(spark, sf):
    g = grid(spark, sf)
    d = dense(spark, sf, g, "price").select("y", "x", F.expr(FLOW).alias("code"))
    return st.flow_in(d, g.ny, g.nx)


@query(
    "gr7_coastal_cells",
    f"""WITH {RASTER}, {DENSE}, off AS (SELECT dy, dx FROM (SELECT unnest([-1, 0, 1]) AS dy), (SELECT unnest([-1, 0, 1]) AS dx) WHERE dy <> 0 OR dx <> 0)
SELECT DISTINCT c.y, c.x FROM dense c, off JOIN dense n ON n.y = least(greatest(c.y + dy, 0), c.ny - 1) AND n.x = (c.x + dx + c.nx) % c.nx
WHERE c.land = 1 AND n.land = 0""",
)
def coastal_cells(spark, sf):
    g = grid(spark, sf)
    sea = raster(spark, sf, g).select("y", "x", (1 - F.col("land")).alias("sea"))
    return coastal(sea, g.ny, g.nx)


FILL_SQL = f"""{RASTER}, {AXES}, {DENSE},
p AS (SELECT d.y, d.x, d.value, d.land, CAST(d.y AS BIGINT) * nx + d.x AS cell, cos(radians(ay.point)) * cos(radians(ax.point)) AS px,
  cos(radians(ay.point)) * sin(radians(ax.point)) AS py, sin(radians(ay.point)) AS pz
  FROM dense d JOIN ay ON ay.idx = d.y JOIN ax ON ax.idx = d.x)"""
CHORD = "round(sqrt((m.px - v.px) * (m.px - v.px) + (m.py - v.py) * (m.py - v.py) + (m.pz - v.pz) * (m.pz - v.pz)), 9)"


@query(
    "jn17_fill_missing",
    f"""WITH {FILL_SQL}, best AS (SELECT m.cell, arg_min(v.value, ({CHORD}, v.cell)) AS value FROM p m, p v
  WHERE m.value IS NULL AND v.value IS NOT NULL GROUP BY m.cell)
SELECT y, x, coalesce(p.value, b.value) AS value FROM p LEFT JOIN best b ON b.cell = p.cell""",
)
def fill_missing(spark, sf):
    g = grid(spark, sf)
    return fi.fill_missing(dense(spark, sf, g, "value"), *axes(spark, g))


@query(
    "jn17_excluded_donors",
    f"""WITH {FILL_SQL}, best AS (SELECT m.cell, arg_min(v.value, ({CHORD}, v.cell)) AS value FROM p m, p v
  WHERE m.value IS NULL AND m.land = 1 AND v.value IS NOT NULL AND v.land = 1 GROUP BY m.cell)
SELECT y, x, CASE WHEN land = 1 THEN coalesce(p.value, b.value) END AS value FROM p LEFT JOIN best b ON b.cell = p.cell""",
)
def excluded_donors(spark, sf):
    g = grid(spark, sf)
    d = dense(spark, sf, g, "value", "land")
    sea = F.coalesce(F.col("land") == 0, F.lit(True))
    out = fi.fill_missing(
        d.select("y", "x", "value"), *axes(spark, g), target_mask=d.select("y", "x", sea.alias("masked")),
        search_mask=d.select("y", "x", sea.alias("excluded")),
    )
    return out


@query(
    "jn19_consistent_with_mask",
    f"""WITH {FILL_SQL}, best AS (SELECT m.cell, arg_min(v.cell, ({CHORD}, v.cell)) AS src FROM p m, p v
  WHERE m.value IS NULL AND m.land = 1 AND v.value IS NOT NULL GROUP BY m.cell)
SELECT t, p.y, p.x, CASE WHEN p.land = 1 THEN coalesce(p.value, s.value) * (t + 1) END AS value FROM p LEFT JOIN best b ON b.cell = p.cell LEFT JOIN p s ON s.cell = b.src,
  (SELECT unnest([0, 1, 2])::INT AS t)""",
)
def consistent_with_mask(spark, sf):
    g = grid(spark, sf)
    d = dense(spark, sf, g, "value", "land")
    slices = d.withColumn("t", F.explode(F.array(*[F.lit(i) for i in range(3)]))).select("t", "y", "x", (F.col("value") * (F.col("t") + 1)).alias("value"))
    return fi.make_consistent(slices, d.select("y", "x", "land"), *axes(spark, g), invert=True, by=["t"])


@query(
    "jn18_fill_mesh",
    """WITH f AS (SELECT o_orderkey AS face, degrees(asin(2 * ((o_totalprice * 7) % 1000) / 1000 - 1)) AS lat, (o_totalprice * 13) % 360 AS lon,
    CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS value FROM orders),
p AS (SELECT *, cos(radians(lat)) * cos(radians(lon)) AS px, cos(radians(lat)) * sin(radians(lon)) AS py, sin(radians(lat)) AS pz FROM f),
best AS (SELECT m.face, arg_min(v.value, (round(sqrt((m.px - v.px) ** 2 + (m.py - v.py) ** 2 + (m.pz - v.pz) ** 2), 9), v.face)) AS value
  FROM p m, p v WHERE m.value IS NULL AND v.value IS NOT NULL GROUP BY m.face)
SELECT p.face AS face_id, coalesce(p.value, b.value) AS value FROM p LEFT JOIN best b ON b.face = p.face""",
)
def fill_mesh(spark, sf):
    o = read(spark, sf, "orders")
    z = 2 * ((F.col("o_totalprice") * 7) % 1000) / 1000 - 1
    faces = o.select(
        F.col("o_orderkey").alias("face_id"), F.degrees(F.asin(z)).alias("lat"), ((F.col("o_totalprice") * 13) % 360).alias("lon"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("value"),
    )
    return fi.fill_mesh(faces).select("face_id", "value")


#: Two outlines: a slanted quadrilateral and a notched one whose corners lie on grid lines' multiples of 10 degrees.
OUTLINES = [
    ("a", [(-60.0, -40.0), (35.5, -20.0), (20.0, 33.0), (-75.0, 10.0)]),
    ("b", [(60.0, 10.0), (120.0, 10.0), (120.0, 60.0), (90.0, 30.0), (60.0, 60.0)]),
]
EDGE_SQL = "e AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{p}', {a[0]}::DOUBLE, {a[1]}::DOUBLE, {b[0]}::DOUBLE, {b[1]}::DOUBLE)" for p, v in OUTLINES for a, b in zip(v, v[1:] + v[:1])
) + ") t(poly, x1, y1, x2, y2))"
INSIDE_SQL = f"""{RASTER}, {AXES}, {EDGE_SQL},
c AS (SELECT r.*, ax.point AS lon, ay.point AS lat, unnest([ax.lo, ax.lo, ax.hi, ax.hi]) AS px, unnest([ay.lo, ay.hi, ay.lo, ay.hi]) AS py
  FROM raster r JOIN ax ON ax.idx = r.x JOIN ay ON ay.idx = r.y),
h AS (SELECT y, x, px, py, poly, count_if((y1 > py) <> (y2 > py) AND px < x1 + (py - y1) / nullif(y2 - y1, 0) * (x2 - x1)) % 2 = 1
    AND NOT bool_or(py BETWEEN least(y1, y2) AND greatest(y1, y2) AND CASE WHEN y1 = y2 THEN px BETWEEN least(x1, x2) AND greatest(x1, x2)
      ELSE px = x1 + (py - y1) / (y2 - y1) * (x2 - x1) END) AS ins
  FROM (SELECT DISTINCT y, x, px, py FROM c), e GROUP BY ALL),
ins AS (SELECT y, x, bool_or(ins) AS inside FROM h GROUP BY y, x)"""


def outlines(spark):
    rows = [(p, i, x, y) for p, v in OUTLINES for i, (x, y) in enumerate(v)]
    return mg.polygon_edges(spark.createDataFrame(rows, "poly STRING, seq INT, px DOUBLE, py DOUBLE"))


@query("jn15_inside_polygons", f"WITH {INSIDE_SQL} SELECT y, x, inside FROM ins")
def inside_polygons(spark, sf):
    g = grid(spark, sf)
    return mg.inside_polygons(raster(spark, sf, g).select("y", "x"), outlines(spark), *axes(spark, g))


@query(
    "jn16_merge_in_polygon",
    f"""WITH {INSIDE_SQL}, p AS (SELECT r.y, r.x, CASE WHEN code = 6 THEN CAST('NaN' AS DOUBLE) ELSE value END AS v, inside, ay.point AS lat, ax.point AS lon
    FROM raster r JOIN ins USING (y, x) JOIN ax ON ax.idx = x JOIN ay ON ay.idx = y WHERE ay.point < 30),
a AS (SELECT ay.point AS lat, ax.point AS lon, -price AS v FROM raster r JOIN ax ON ax.idx = x JOIN ay ON ay.idx = y)
SELECT round(a.lat, 10) AS lat, round(a.lon, 10) AS lon, CASE WHEN p.lat IS NOT NULL AND inside AND NOT coalesce(isnan(p.v), false) THEN p.v ELSE a.v END AS value
FROM a LEFT JOIN p ON p.lat = a.lat AND p.lon = a.lon""",
)
def merge_in_polygon(spark, sf):
    g = grid(spark, sf)
    ay, axx = axes(spark, g)
    r = mg.inside_polygons(raster(spark, sf, g), outlines(spark), ay, axx)
    r = r.join(ay.select(F.col("idx").alias("y"), F.col("point").alias("lat")), "y").join(axx.select(F.col("idx").alias("x"), F.col("point").alias("lon")), "x")
    primary = r.filter("lat < 30").withColumn("value", F.when(F.col("code") == 6, nan()).otherwise(F.col("value")))
    return mg.merge(primary, r.withColumn("value", -F.col("price")), valid="inside")


@query(
    "jn16_merge_straddling",
    f"""WITH {RASTER}, {AXES}, c AS (SELECT ay.point AS lat, ax.point AS lon, code, value, price FROM raster JOIN ax ON ax.idx = x JOIN ay ON ay.idx = y),
px AS (SELECT DISTINCT lon FROM c WHERE lat < 30)
SELECT round(lat + CASE WHEN lat < 30 THEN 4.9e-11::DOUBLE ELSE 5.1e-11::DOUBLE END, 10) AS lat,
  round(lon + CASE WHEN lon IN (SELECT lon FROM px) THEN 4.9e-11::DOUBLE ELSE 5.1e-11::DOUBLE END, 10) AS lon,
  CASE WHEN lat < 30 AND code <> 6 THEN value ELSE -price END AS value FROM c""",
)
def merge_straddling(spark, sf):
    """Two sources whose coordinates differ by a fiftieth of the tolerance, to either side of a rounding step."""
    g = grid(spark, sf)
    ay, axx = axes(spark, g)
    r = raster(spark, sf, g).join(ay.select(F.col("idx").alias("y"), F.col("point").alias("lat")), "y").join(axx.select(F.col("idx").alias("x"), F.col("point").alias("lon")), "x")
    primary = r.filter("lat < 30").select((F.col("lat") + 4.9e-11).alias("lat"), (F.col("lon") + 4.9e-11).alias("lon"), F.when(F.col("code") == 6, nan()).otherwise(F.col("value")).alias("value"))
    return mg.merge(primary, r.select((F.col("lat") + 5.1e-11).alias("lat"), (F.col("lon") + 5.1e-11).alias("lon"), (-F.col("price")).alias("value")))


@query(
    "st2_concatenate",
    f"WITH {MONTHLY} SELECT field_id, t, y, x, value FROM monthly",
)
def concatenate(spark, sf):
    m = monthly(spark, sf)
    return mg.concatenate([m.filter("t < 40"), m.filter("t >= 40")], ["field_id", "t", "y", "x"])


@query(
    "st3_overwrite",
    f"WITH {RASTER} SELECT y, x, CASE WHEN y BETWEEN 5 AND 20 AND x BETWEEN 7 AND 90 THEN CASE WHEN status <> 'F' THEN -price END ELSE price END AS price FROM raster",
)
def overwrite(spark, sf):
    r = raster(spark, sf)
    patch = r.filter("y BETWEEN 5 AND 20 AND x BETWEEN 7 AND 90").withColumn("price", F.when(F.col("status") != "F", -F.col("price")))
    return mg.overwrite(r.select("y", "x", "price"), patch, ["y", "x"], "price")


@query("jn24_mask_by", f"WITH {MONTHLY}, {RASTER} SELECT field_id, t, m.y, m.x, CASE WHEN r.value IS NOT NULL THEN m.value END AS value FROM monthly m LEFT JOIN raster r ON r.y = m.y AND r.x = m.x")
def mask_by(spark, sf):
    r = raster(spark, sf).select("y", "x", "value")
    return mg.mask_by(monthly(spark, sf), r, ["y", "x"])


@query(
    "jn11_pair_fields",
    """SELECT a.p_partkey AS primary_id, b.p_partkey AS alternate_id, CASE WHEN a.p_partkey % 3 = 0 THEN CAST(a.p_partkey + 7 AS VARCHAR) ELSE a.p_name || a.p_partkey END AS matched_on
FROM part a JOIN part b ON a.p_partkey = b.p_partkey""",
)
def pair_fields(spark, sf):
    p = read(spark, sf, "part")
    cat = p.select(
        F.col("p_partkey").alias("field_id"), F.when(F.col("p_partkey") % 3 == 0, F.col("p_partkey") + 7).alias("stash"),
        F.concat("p_name", F.col("p_partkey").cast("string")).alias("name"),
    )
    return mg.pair_fields(cat, cat)


@query(
    "qa3_merge_compatible",
    """SELECT p_partkey AS field_id, p_size IS NOT DISTINCT FROM CASE WHEN p_size > 40 THEN NULL ELSE p_size END AS same_stash,
  p_brand = 'Brand#' || p_partkey % 5 AS same_units, true AS same_standard_name,
  (p_size IS NOT DISTINCT FROM CASE WHEN p_size > 40 THEN NULL ELSE p_size END) AND p_brand = 'Brand#' || p_partkey % 5 AS compatible FROM part""",
)
def merge_compatible(spark, sf):
    p = read(spark, sf, "part")
    a = p.select(F.col("p_partkey").alias("field_id"), F.col("p_size").alias("stash"), F.col("p_brand").alias("units"), F.col("p_type").alias("standard_name"))
    b = a.withColumn("stash", F.when(F.col("stash") <= 40, F.col("stash"))).withColumn("units", F.concat(F.lit("Brand#"), (F.col("field_id") % 5).cast("string")))
    return mg.compatible(a, b)
