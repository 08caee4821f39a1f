"""Grids, regridding and weights."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridloom.functions import projection
from gridloom.operators import curved, regrid
from gridloom.sources import axes as ax
from workload.fixtures import (
    AXES, MONTH_AXES, MONTHLY, RASTER, axes, axis_sql, grid, month_axes, monthly, raster, read,
)
from workload.registry import query

SINLAT = "sin(radians(least(greatest({}, -90.0::DOUBLE), 90.0::DOUBLE)))"


def overlap_sql(name, src, tgt, spherical):
    lo, hi = "greatest(s.lo, t.lo)", "least(s.hi, t.hi)"
    w = f"{SINLAT.format(hi)} - {SINLAT.format(lo)}" if spherical else f"{hi} - {lo}"
    return (
        f"{name} AS (SELECT s.idx AS s, t.idx AS t, {w} AS w FROM {src} s, {tgt} t "
        "WHERE least(s.hi, t.hi) - greatest(s.lo, t.lo) > 1e-10)"
    )


ODD = axis_sql("oy", 17, -90.0, "180.0::DOUBLE / 17") + ",\n" + axis_sql("ox", 31, -180.0, "360.0::DOUBLE / 31")


def odd_axes(spark):
    return ax.regular_axis(spark, 17, -90.0, 180.0 / 17), ax.regular_axis(spark, 31, -180.0, 360.0 / 31)


@query(
    "jn1_area_weighted_regrid",
    f"""WITH {MONTHLY}, {MONTH_AXES}, {ODD}, {overlap_sql('wx', 'mx', 'ox', False)}, {overlap_sql('wy', 'my', 'oy', True)}
SELECT field_id, t, y, x, round(value, 6) AS value FROM (
  SELECT m.field_id, m.t, wy.t AS y, wx.t AS x, sum(value * wx.w * wy.w) / sum(wx.w * wy.w) AS value
  FROM monthly m JOIN wx ON wx.s = m.x JOIN wy ON wy.s = m.y GROUP BY ALL)""",
)
def area_weighted_regrid(spark, sf):
    out = regrid.area_weighted(monthly(spark, sf), *month_axes(spark), *odd_axes(spark), by=["field_id", "t"])
    return out.withColumn("value", F.round("value", 6))


HALF = """hy AS (SELECT CAST(i AS INT) AS idx, -90.0::DOUBLE + (i + 0.5::DOUBLE) * (180.0::DOUBLE / nyh) AS point,
  -90.0::DOUBLE + i * (180.0::DOUBLE / nyh) AS lo, -90.0::DOUBLE + (i + 1) * (180.0::DOUBLE / nyh) AS hi
  FROM (SELECT ny * 5 // 13 AS nyh FROM dims), range((SELECT ny * 5 // 13 FROM dims)) r(i)),
hx AS (SELECT CAST(i AS INT) AS idx, -180.0::DOUBLE + (i + 0.5::DOUBLE) * (360.0::DOUBLE / nxh) AS point,
  -180.0::DOUBLE + i * (360.0::DOUBLE / nxh) AS lo, -180.0::DOUBLE + (i + 1) * (360.0::DOUBLE / nxh) AS hi
  FROM (SELECT nx * 5 // 13 AS nxh FROM dims), range((SELECT nx * 5 // 13 FROM dims)) r(i))"""


def coarse_axes(spark, g):
    ny, nx = g.ny * 5 // 13, g.nx * 5 // 13
    return ax.regular_axis(spark, ny, -90.0, 180.0 / ny), ax.regular_axis(spark, nx, -180.0, 360.0 / nx)


MEAN_SQL = f"""WITH {RASTER}, {AXES}, {HALF}, {overlap_sql('wx', 'ax', 'hx', False)}, {overlap_sql('wy', 'ay', 'hy', True)},
sums AS (SELECT wy.t AS y, wx.t AS x, sum(value * wx.w * wy.w) AS a, sum(value * value * wx.w * wy.w) AS b,
    sum(CASE WHEN value IS NOT NULL THEN wx.w * wy.w END) AS w
  FROM raster r JOIN wx ON wx.s = r.x JOIN wy ON wy.s = r.y GROUP BY ALL)"""


@query("ag1_masked_mean", f"{MEAN_SQL} SELECT y, x, round(a / w, 5) AS value FROM sums")
def masked_mean(spark, sf):
    g = grid(spark, sf)
    out = regrid.area_weighted(raster(spark, sf, g), *axes(spark, g), *coarse_axes(spark, g))
    return out.withColumn("value", F.round("value", 5))


@query(
    "ag2_area_stdev",
    f"{MEAN_SQL} SELECT y, x, round(a / w, 5) AS value, round(sqrt(abs(b / w - (a / w) * (a / w))), 4) AS stdev FROM sums",
)
def area_stdev(spark, sf):
    g = grid(spark, sf)
    out = regrid.area_weighted(raster(spark, sf, g), *axes(spark, g), *coarse_axes(spark, g), stdev=True)
    return out.withColumn("value", F.round("value", 5)).withColumn("stdev", F.round("stdev", 4))


@query(
    "jn1_outside_domain",
    f"""WITH {RASTER}, {AXES}, {axis_sql('ty', 9, -45.0, '10.0::DOUBLE')}, {axis_sql('tx', 18, -100.0, '11.0::DOUBLE')},
cy AS (SELECT * FROM ay WHERE lo >= -40 AND hi <= 40), cx AS (SELECT * FROM ax WHERE lo >= -90 AND hi <= 90),
{overlap_sql('wx', 'cx', 'tx', False)}, {overlap_sql('wy', 'cy', 'ty', True)},
ex AS (SELECT min(cx.lo) AS xlo, max(cx.hi) AS xhi FROM cx), ey AS (SELECT min(cy.lo) AS ylo, max(cy.hi) AS yhi FROM cy)
SELECT y, x, CASE WHEN inside THEN round(v, 5) ELSE CAST('NaN' AS DOUBLE) END AS value FROM (
  SELECT wy.t AS y, wx.t AS x, sum(value * wx.w * wy.w) / sum(CASE WHEN value IS NOT NULL THEN wx.w * wy.w END) AS v,
    bool_and(tx.lo >= xlo - 1e-9 AND tx.hi <= xhi + 1e-9 AND ty.lo >= ylo - 1e-9 AND ty.hi <= yhi + 1e-9) AS inside
  FROM raster r JOIN wx ON wx.s = r.x JOIN wy ON wy.s = r.y JOIN tx ON tx.idx = wx.t JOIN ty ON ty.idx = wy.t, ex, ey
  GROUP BY ALL)""",
)
def outside_domain(spark, sf):
    g = grid(spark, sf)
    ay, axx = axes(spark, g)
    ay, axx = ay.filter("lo >= -40 AND hi <= 40"), axx.filter("lo >= -90 AND hi <= 90")
    ty, tx = ax.regular_axis(spark, 9, -45.0, 10.0), ax.regular_axis(spark, 18, -100.0, 11.0)
    out = regrid.area_weighted(raster(spark, sf, g), ay, axx, ty, tx)
    return out.withColumn("value", F.round("value", 5))


@query(
    "jn1_shifted_period",
    f"""WITH {RASTER}, {AXES}, {axis_sql('ty', 12, -90.0, '15.0::DOUBLE')}, {axis_sql('t0', 25, 7.0, '360.0::DOUBLE / 25')},
tx AS (SELECT idx, lo - 360 * k AS lo, hi - 360 * k AS hi FROM t0, (SELECT unnest([0, 1]) AS k)),
{overlap_sql('wx', 'ax', 'tx', False)}, {overlap_sql('wy', 'ay', 'ty', True)}
SELECT y, x, round(v, 5) AS value FROM (SELECT wy.t AS y, wx.t AS x,
  sum(value * wx.w * wy.w) / sum(CASE WHEN value IS NOT NULL THEN wx.w * wy.w END) AS v
  FROM raster r JOIN wx ON wx.s = r.x JOIN wy ON wy.s = r.y GROUP BY ALL)""",
)
def shifted_period(spark, sf):
    g = grid(spark, sf)
    ty, tx = ax.regular_axis(spark, 12, -90.0, 15.0), ax.regular_axis(spark, 25, 7.0, 360.0 / 25)
    out = regrid.area_weighted(raster(spark, sf, g), *axes(spark, g), ty, tx)
    return out.withColumn("value", F.round("value", 5))


@query(
    "jn4_zonal_mean_target",
    f"""WITH {MONTHLY}, {MONTH_AXES}, {axis_sql('oy', 17, -90.0, '180.0::DOUBLE / 17')}, {overlap_sql('wy', 'my', 'oy', True)},
zonal AS (SELECT field_id, t, y, avg(value) AS value FROM monthly GROUP BY ALL)
SELECT field_id, t, y, 0 AS x, round(v, 6) AS value FROM (
  SELECT field_id, z.t, wy.t AS y, sum(value * wy.w) / sum(wy.w) AS v FROM zonal z JOIN wy ON wy.s = z.y GROUP BY ALL)""",
)
def zonal_mean_target(spark, sf):
    my, _ = month_axes(spark)
    column = ax.regular_axis(spark, 1, -180.0, 360.0)
    oy, ox = odd_axes(spark)
    z = monthly(spark, sf).groupBy("field_id", "t", "y").agg(F.avg("value").alias("value")).withColumn("x", F.lit(0))
    out = regrid.area_weighted(z, my, column, oy, regrid.zonal_target(column, ox), by=["field_id", "t"])
    return out.withColumn("value", F.round("value", 6))


BRACKET_X = """bx AS (SELECT t.idx AS t, s.idx AS s0, (s.idx + 1) % nx AS s1, (t.p - s.point) / (s.p1 - s.point) AS w
  FROM (SELECT idx, point, coalesce(lead(point) OVER (ORDER BY idx), first_value(point) OVER (ORDER BY idx) + 360) AS p1 FROM ax) s,
    (SELECT idx, CASE WHEN point < (SELECT min(point) FROM ax) THEN point + 360 ELSE point END AS p FROM ox) t, dims
  WHERE t.p >= s.point AND t.p < s.p1),
wx AS (SELECT t, s0 AS s, 1 - w AS w FROM bx WHERE 1 - w <> 0 UNION ALL SELECT t, s1, w FROM bx WHERE w <> 0)"""
BRACKET_Y = """byy AS (SELECT t.idx AS t, s.idx AS s0, (t.point - s.point) / (s.p1 - s.point) AS w, t.point BETWEEN mn AND mx AS inside
  FROM (SELECT idx, point, lead(point) OVER (ORDER BY idx) AS p1 FROM ay) s, oy t,
    (SELECT min(point) AS mn, max(point) AS mx FROM ay)
  WHERE s.p1 IS NOT NULL AND least(greatest(t.point, mn), mx) >= s.point
    AND (least(greatest(t.point, mn), mx) < s.p1 OR (s.p1 = mx AND t.point >= mx))),
wy AS (SELECT t, s0 AS s, 1 - w AS w, inside FROM byy WHERE 1 - w <> 0 UNION ALL SELECT t, s0 + 1, w, inside FROM byy WHERE w <> 0)"""


def bilinear_sql(mode):
    inside = "bool_and(inside)" if mode == "nan" else "true"
    return f"""WITH {RASTER}, {AXES}, {ODD}, {BRACKET_X}, {BRACKET_Y},
need AS (SELECT wy.t AS y, wx.t AS x, count(*) AS need FROM wx, wy GROUP BY ALL)
SELECT g.y, g.x, CASE WHEN inside THEN CASE WHEN n = need THEN round(v, 5) END ELSE CAST('NaN' AS DOUBLE) END AS value FROM (
  SELECT wy.t AS y, wx.t AS x, sum(value * wx.w * wy.w) AS v, count(value) AS n, {inside} AS inside
  FROM raster r JOIN wx ON wx.s = r.x JOIN wy ON wy.s = r.y GROUP BY ALL) g JOIN need ON need.y = g.y AND need.x = g.x"""


@query("jn3_bilinear", bilinear_sql("nan"))
def bilinear(spark, sf):
    g = grid(spark, sf)
    out = regrid.bilinear(raster(spark, sf, g), *axes(spark, g), *odd_axes(spark), period=360.0)
    return out.withColumn("value", F.round("value", 5))


@query("jn3_bilinear_extrapolate", bilinear_sql("linear"))
def bilinear_extrapolate(spark, sf):
    g = grid(spark, sf)
    out = regrid.bilinear(raster(spark, sf, g), *axes(spark, g), *odd_axes(spark), mode="linear", period=360.0)
    return out.withColumn("value", F.round("value", 5))


@query(
    "jn5_nearest_regrid",
    f"""WITH {RASTER}, {AXES}, {ODD},
wx AS (SELECT o.idx AS t, arg_max(a.idx, (-round(least(abs(a.point - o.point), 360 - abs(a.point - o.point)), 9), a.idx)) AS s FROM ax a, ox o GROUP BY ALL),
wy AS (SELECT o.idx AS t, arg_max(a.idx, (-round(abs(a.point - o.point), 9), a.idx)) AS s FROM ay a, oy o GROUP BY ALL)
SELECT wy.t AS y, wx.t AS x, code, value FROM raster r JOIN wx ON wx.s = r.x JOIN wy ON wy.s = r.y""",
)
def nearest_regrid(spark, sf):
    g = grid(spark, sf)
    return regrid.nearest(raster(spark, sf, g).select("y", "x", "code", "value"), *axes(spark, g), *odd_axes(spark), period=360.0)


WEIGHTS_SQL = f"""{RASTER}, {AXES}, {ODD}, {overlap_sql('ox_', 'ax', 'ox', False)}, {overlap_sql('oy_', 'ay', 'oy', True)},
weights AS (SELECT oy_.s * nx + ox_.s AS src_cell, oy_.t * 31 + ox_.t AS tgt_cell,
  ox_.w / (x.hi - x.lo) * oy_.w / (sin(radians(y.hi)) - sin(radians(y.lo))) AS w
  FROM ox_, oy_, ox x, oy y, dims WHERE x.idx = ox_.t AND y.idx = oy_.t)"""


def weights_table(spark, g):
    w = regrid.rectilinear_weights(*axes(spark, g), *odd_axes(spark))
    return w.select(
        (F.col("sy") * g.nx + F.col("sx")).alias("src_cell"), (F.col("ty") * 31 + F.col("tx")).alias("tgt_cell"), "w"
    )


@query(
    "jn6_sparse_weights",
    f"""WITH {WEIGHTS_SQL} SELECT tgt_cell, CASE WHEN bool_or(value IS NULL) THEN NULL ELSE round(sum(value * w), 5) END AS value
FROM (SELECT *, y * nx + x AS src_cell FROM raster WHERE status <> 'X') r JOIN weights USING (src_cell) GROUP BY tgt_cell""",
)
def sparse_weights(spark, sf):
    g = grid(spark, sf)
    cells = raster(spark, sf, g).withColumn("src_cell", F.col("y") * g.nx + F.col("x"))
    out = regrid.apply_weights(cells, weights_table(spark, g))
    return out.withColumn("value", F.round("value", 5))


@query(
    "jn7_grid_to_mesh",
    f"""WITH {WEIGHTS_SQL} SELECT tgt_cell AS face, round(sum(price * w) / sum(w), 3) AS value
FROM (SELECT price, y * nx + x AS src_cell FROM raster) r JOIN weights USING (src_cell) GROUP BY tgt_cell""",
)
def grid_to_mesh(spark, sf):
    g = grid(spark, sf)
    cells = raster(spark, sf, g).select("price", (F.col("y") * g.nx + F.col("x")).alias("src_cell"))
    out = regrid.apply_weights(cells, weights_table(spark, g), value="price", normalise=True, digits=12)
    return out.select(F.col("tgt_cell").alias("face"), F.round("price", 3).alias("value"))


#: Faces between great circles only: lunes from a pole to the equator, as wide as the numbers of their orders' days say.
LUNES = """w AS (SELECT k, count(*) AS n FROM (SELECT o_orderkey % 24 AS k FROM orders) GROUP BY k),
lune AS (SELECT CAST(k AS INT) AS face, -180 + 360.0::DOUBLE * (sum(n) OVER (ORDER BY k) - n) / sum(n) OVER () AS lo, -180 + 360.0::DOUBLE * sum(n) OVER (ORDER BY k) / sum(n) OVER () AS hi FROM w)"""


@query(
    "jn7_mesh_of_lunes",
    f"""WITH {RASTER}, {AXES}, {LUNES}, col AS (SELECT x, avg(price) AS v FROM raster GROUP BY x),
o AS (SELECT face, x, v, least(l.hi, ax.hi) - greatest(l.lo, ax.lo) AS w FROM lune l JOIN ax ON ax.hi > l.lo AND ax.lo < l.hi JOIN col ON col.x = ax.idx)
SELECT 2 * face + k AS face, round(v, 4) AS value FROM (SELECT face, sum(v * w) / sum(w) AS v FROM o GROUP BY face), (SELECT unnest([0, 1]) AS k)""",
)
def mesh_of_lunes(spark, sf):
    """A source of two rows with the mean price of each column, to a mesh with two faces per lune: what covers them is known in closed form."""
    g = grid(spark, sf)
    n = read(spark, sf, "orders").groupBy((F.col("o_orderkey") % 24).cast("int").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy("k")  # one row per lune
    lune = n.withColumn("hi", F.sum("n").over(w)).withColumn("lo", F.col("hi") - F.col("n"))
    total = read(spark, sf, "orders").count()
    edge = lambda c: F.lit(-180.0) + F.lit(360.0) * c / F.lit(float(total))
    corner = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), a.alias("lat"), o.alias("lon")) for i, (a, o) in enumerate(
        [(F.lit(0.0), edge(F.col("lo"))), (F.lit(0.0), edge(F.col("hi"))), (F.lit(90.0), edge(F.col("lo"))), (F.lit(-90.0), edge(F.col("lo")))])]))
    nodes = lune.withColumn("c", corner).select((F.col("k") * 4 + F.col("c.i")).alias("node_id"), "c.lat", "c.lon")
    first = F.col("k") * 4 + 1
    faces = lune.select(F.explode(F.array(
        F.struct((2 * F.col("k")).alias("face_id"), F.array(first, first + 1, first + 2).alias("nodes")),
        F.struct((2 * F.col("k") + 1).alias("face_id"), F.array(first + 1, first, first + 3).alias("nodes")))).alias("f")).select("f.*")
    column = raster(spark, sf, g).groupBy("x").agg(F.avg("price").alias("value"))
    src = column.withColumn("y", F.explode(F.array(F.lit(0), F.lit(1))))
    out = regrid.to_mesh(src, ax.regular_axis(spark, 2, -90.0, 90.0), axes(spark, g)[1], faces, nodes)
    return out.select(F.col("face_id").alias("face"), F.round("value", 4).alias("value"))


@query("fn6_weight_closure", "SELECT CAST(i AS BIGINT) AS cell, 1.0::DOUBLE AS covered FROM range(17 * 31) r(i) WHERE (SELECT count(*) FROM orders) > 0")
def weight_closure(spark, sf):
    """The displaced grid covers the globe, so every target cell is covered once."""
    w = displaced_weights(spark, sf, grid(spark, sf))
    return w.groupBy(F.col("tgt_cell").alias("cell")).agg(F.round(F.sum("w"), 7).alias("covered"))


@query(
    "jn7_split_zonal_column",
    f"""WITH {MONTHLY} SELECT field_id, t, y, x, round(v, 6) AS value FROM (
  SELECT field_id, t, y, avg(value) AS v FROM monthly GROUP BY ALL), (SELECT unnest(range(12))::INT AS x)""",
)
def split_zonal_column(spark, sf):
    z = monthly(spark, sf).groupBy("field_id", "t", "y").agg(F.round(F.avg("value"), 6).alias("value")).withColumn("x", F.lit(0))
    return regrid.split_column(z)


def outline_sql(name, v0, v1, u0, u1, steps=64):
    """Points ``(v, u)`` along the sides of a box given by four SQL numbers."""
    side = f"FROM box_{name}, range({steps}) r(k)"
    cols = [("v0", "u0 + k / 64.0::DOUBLE * (u1 - u0)"), ("v0 + k / 64.0::DOUBLE * (v1 - v0)", "u1"), ("v1", "u1 - k / 64.0::DOUBLE * (u1 - u0)"), ("v1 - k / 64.0::DOUBLE * (v1 - v0)", "u0")]
    return f"box_{name} AS (SELECT {v0} AS v0, {v1} AS v1, {u0} AS u0, {u1} AS u1),\n{name} AS (" + " UNION ALL ".join(f"SELECT {v} AS v, {u} AS u {side}" for v, u in cols) + ")"


#: From the points ``geo (lat, lon)`` of the target's outline: the rows and columns of the source below it, one more on each side.
CROP = """lats AS (SELECT min(lat) AS v_lo, max(lat) AS v_hi FROM geo),
turn AS (SELECT t, lead(t) OVER (ORDER BY t) AS n, min(t) OVER () + 360 AS over FROM (SELECT lon - 360 * floor(lon / 360) AS t FROM geo)),
arc AS (SELECT max(struct_pack(gap := coalesce(n, over) - t, start := coalesce(n, over))) AS m FROM turn),
lons AS (SELECT m.start AS u_lo, m.start + 360 - m.gap AS u_hi FROM arc),
cys AS (SELECT DISTINCT idx + d AS idx FROM sy, lats, (SELECT unnest([-1, 0, 1]) AS d) WHERE lo < v_hi - 1e-10 AND hi > v_lo + 1e-10),
cxs AS (SELECT DISTINCT (idx + d + n) % n AS idx FROM (SELECT *, lo - 360 * floor((lo - u_lo) / 360) AS a, count(*) OVER () AS n FROM sx, lons), (SELECT unnest([-1, 0, 1]) AS d)
  WHERE a < u_hi - 1e-10 OR a + hi - lo > u_lo + 360 + 1e-10),
cut AS (SELECT (SELECT count(*) FROM sy JOIN cys USING (idx)) AS my, (SELECT count(*) FROM cxs) AS mx)"""
#: From the places ``pt (y, x, lat, lon)`` of the intermediate cells: their values, from the four points around each.
INTERPOLATE = """gy AS (SELECT idx AS i0, point AS p0, lead(idx) OVER (ORDER BY point) AS i1, lead(point) OVER (ORDER BY point) AS p1 FROM sy),
gx AS (SELECT idx AS i0, point AS p0, coalesce(lead(idx) OVER (ORDER BY point), first_value(idx) OVER (ORDER BY point)) AS i1,
  coalesce(lead(point) OVER (ORDER BY point), first_value(point) OVER (ORDER BY point) + 360) AS p1, min(point) OVER () AS low FROM sx),
span AS (SELECT min(point) AS lo, max(point) AS hi FROM sy),
q AS (SELECT y, x, lat BETWEEN s.lo - 1e-10 AND s.hi + 1e-10 AS inside, least(greatest(lat, s.lo), s.hi) AS c, lon - 360 * floor((lon - low) / 360) AS l FROM pt, span s, (SELECT min(low) AS low FROM gx)),
k AS (SELECT q.y, q.x, inside, gy.i0 AS y0, gy.i1 AS y1, (c - gy.p0) / (gy.p1 - gy.p0) AS fy, gx.i0 AS x0, gx.i1 AS x1, (l - gx.p0) / (gx.p1 - gx.p0) AS fx FROM q
  JOIN gy ON c >= gy.p0 AND (c < gy.p1 OR gy.p1 = (SELECT hi FROM span) AND c = gy.p1) JOIN gx ON l >= gx.p0 AND l < gx.p1),
c AS (SELECT y, x, inside, CASE j WHEN 1 THEN y1 ELSE y0 END AS sy, CASE i WHEN 1 THEN x1 ELSE x0 END AS sx, CASE j WHEN 1 THEN fy ELSE 1 - fy END * CASE i WHEN 1 THEN fx ELSE 1 - fx END AS w
  FROM k, (SELECT unnest([0, 0, 1, 1]) AS j, unnest([0, 1, 0, 1]) AS i)),
mid AS (SELECT c.y, c.x, CASE WHEN bool_and(inside) THEN CASE WHEN count(price) = count(*) THEN sum(price * w) END ELSE CAST('NaN' AS DOUBLE) END AS v
  FROM c LEFT JOIN raster r ON r.y = c.sy AND r.x = c.sx WHERE w <> 0 GROUP BY c.y, c.x)"""


def cover_sql(name, size, lo, hi):
    step = f"({hi} - ({lo}))::DOUBLE / {size}"
    return f"{name} AS (SELECT CAST(i AS INT) AS idx, {lo} + i * ({step}) AS lo, {lo} + (i + 1) * ({step}) AS hi, {lo} + (i + 0.5::DOUBLE) * ({step}) AS p FROM cut, range((SELECT {size} FROM cut)) r(i))"


def two_stage_sql(source, box, target, geo, places, spherical, before=""):
    """Oracle of a two-stage regrid of the raster's price: the cropped target is the whole target, which the source surrounds."""
    v0, v1, u0, u1 = box
    return f"""WITH {RASTER}, {source}, {target}, {outline_sql('ring', v0, v1, u0, u1)}, {before}geo AS ({geo}),
{CROP}, {cover_sql('vy', 'my', v0, v1)}, {cover_sql('vx', 'mx', u0, u1)}, {places}, {INTERPOLATE},
{overlap_sql('wx', 'vx', 'tx', False)}, {overlap_sql('wy', 'vy', 'ty', spherical)}
SELECT y, x, round(v, 4) AS value FROM (SELECT wy.t AS y, wx.t AS x, sum(v * wx.w * wy.w) / sum(CASE WHEN v IS NOT NULL THEN wx.w * wy.w END) AS v FROM mid JOIN wx ON wx.s = mid.x JOIN wy ON wy.s = mid.y GROUP BY ALL)"""


def unrotate_sql(v, u, table):
    """Geographic place of a point seen from the pole (37.5, 177.5)."""
    return f"""degrees(asin(sin({v}) * sin(th) + cos({v}) * cos({u}) * cos(th))) AS lat,
  degrees(atan2(cos({v}) * sin({u}), cos({v}) * cos({u}) * sin(th) - sin({v}) * cos(th))) - 2.5 AS lon FROM {table}, (SELECT radians(37.5::DOUBLE) AS th)"""


SOURCE = AXES + ", sy AS (SELECT idx, point, lo, hi FROM ay), sx AS (SELECT idx, point, lo, hi FROM ax)"
ROTATED = (
    ("-30::DOUBLE", "30::DOUBLE", "-40::DOUBLE", "40::DOUBLE"), f"{axis_sql('ty', 12, -30.0, '5.0::DOUBLE')}, {axis_sql('tx', 16, -40.0, '5.0::DOUBLE')}",
    "SELECT " + unrotate_sql("radians(v)", "radians(u)", "ring"), "pt AS (SELECT vy.idx AS y, vx.idx AS x, " + unrotate_sql("radians(vy.p)", "radians(vx.p)", "vy, vx") + ")", True,
)


def rotated_target(spark):
    return ax.regular_axis(spark, 12, -30.0, 5.0), ax.regular_axis(spark, 16, -40.0, 5.0)


@query("jn2_two_stage_rotated", two_stage_sql(SOURCE, *ROTATED))
def two_stage_rotated(spark, sf):
    g = grid(spark, sf)
    r = raster(spark, sf, g).withColumn("value", F.col("price"))
    out = regrid.two_stage(r, *axes(spark, g), *rotated_target(spark), tgt_system=(37.5, 177.5))
    return out.withColumn("value", F.round("value", 4))


#: Global axes whose cells grow towards the north and the east.
UNEVEN = """sy AS (SELECT CAST(i AS INT) AS idx, -90 + 180 * ((i / ny::DOUBLE) ** 1.2 + ((i + 1) / ny::DOUBLE) ** 1.2) / 2 AS point, -90 + 180 * (i / ny::DOUBLE) ** 1.2 AS lo, -90 + 180 * ((i + 1) / ny::DOUBLE) ** 1.2 AS hi
  FROM dims, range((SELECT ny FROM dims)) r(i)),
sx AS (SELECT CAST(i AS INT) AS idx, -180 + 360 * ((i / nx::DOUBLE) ** 1.1 + ((i + 1) / nx::DOUBLE) ** 1.1) / 2 AS point, -180 + 360 * (i / nx::DOUBLE) ** 1.1 AS lo, -180 + 360 * ((i + 1) / nx::DOUBLE) ** 1.1 AS hi
  FROM dims, range((SELECT nx FROM dims)) r(i))"""


def uneven_axis(spark, n, start, length, power):
    lo, hi = f"{start}D + {length}D * pow(id / {n}D, {power}D)", f"{start}D + {length}D * pow((id + 1) / {n}D, {power}D)"
    return spark.range(n).selectExpr("CAST(id AS INT) AS idx", f"{start}D + {length}D * (pow(id / {n}D, {power}D) + pow((id + 1) / {n}D, {power}D)) / 2 AS point", f"{lo} AS lo", f"{hi} AS hi")


@query("jn2_two_stage_uneven", two_stage_sql(UNEVEN, *ROTATED))
def two_stage_uneven(spark, sf):
    g = grid(spark, sf)
    r = raster(spark, sf, g).withColumn("value", F.col("price"))
    src = uneven_axis(spark, g.ny, -90.0, 180.0, 1.2), uneven_axis(spark, g.nx, -180.0, 360.0, 1.1)
    out = regrid.two_stage(r, *src, *rotated_target(spark), tgt_system=(37.5, 177.5))
    return out.withColumn("value", F.round("value", 4))


# Airy 1830 ellipsoid and the British national grid.
AIRY = "SELECT 6377563.396::DOUBLE AS a, 6356256.909::DOUBLE AS b, 0.9996012717::DOUBLE AS f0, radians(49.0::DOUBLE) AS p0, radians(-2.0::DOUBLE) AS l0"
ARC = """b * f0 * ((1 + n + 1.25::DOUBLE * n ** 2 + 1.25::DOUBLE * n ** 3) * (p - p0) - (3 * n + 3 * n ** 2 + 2.625::DOUBLE * n ** 3) * sin(p - p0) * cos(p + p0)
  + 1.875::DOUBLE * (n ** 2 + n ** 3) * sin(2 * (p - p0)) * cos(2 * (p + p0)) - 35 / 24.0::DOUBLE * n ** 3 * sin(3 * (p - p0)) * cos(3 * (p + p0)))"""


def british_sql(name, table, v, u, keys):
    """Tables that end in `name`: latitude and longitude of northing `v` and easting `u`, the foot latitude found in eight steps."""
    steps = [f"{name}0 AS (SELECT {keys}{v} + 100000 AS m, {u} - 400000 AS de, e.*, (a - b) / (a + b) AS n, 1 - (b / a) ** 2 AS e2, ({v} + 100000) / (a * f0) + p0 AS p FROM {table}, ({AIRY}) e)"]
    steps += [f"{name}{k} AS (SELECT * REPLACE (p + (m - {ARC}) / (a * f0) AS p) FROM {name}{k - 1})" for k in range(1, 9)]
    names = ", ".join(k.split(" AS ")[-1].strip() for k in keys.split(",") if k.strip())
    names = names + ", " if names else ""
    steps.append(f"{name}r AS (SELECT *, a * f0 / sqrt(1 - e2 * sin(p) ** 2) AS nu, a * f0 / sqrt(1 - e2 * sin(p) ** 2) * (1 - e2) / (1 - e2 * sin(p) ** 2) AS rho, tan(p) AS t FROM {name}8)")
    steps.append(f"""{name} AS (SELECT {names}degrees(p - t / (2 * rho * nu) * de ** 2 + t / (24 * rho * nu ** 3) * (5 + 3 * t * t + h - 9 * t * t * h) * de ** 4 - t / (720 * rho * nu ** 5) * (61 + 90 * t * t + 45 * t ** 4) * de ** 6) AS lat,
  degrees(l0 + (de / nu - de ** 3 / (6 * nu ** 3) * (nu / rho + 2 * t * t) + de ** 5 / (120 * nu ** 5) * (5 + 28 * t * t + 24 * t ** 4) - de ** 7 / (5040 * nu ** 7) * (61 + 662 * t * t + 1320 * t ** 4 + 720 * t ** 6)) / cos(p)) AS lon
  FROM (SELECT *, nu / rho - 1 AS h FROM {name}r))""")
    return ", ".join(steps)


@query(
    "jn2_two_stage_british",
    two_stage_sql(
        SOURCE, ("0::DOUBLE", "1250000::DOUBLE", "0::DOUBLE", "700000::DOUBLE"), f"{axis_sql('ty', 10, 0.0, '125000.0::DOUBLE')}, {axis_sql('tx', 7, 0.0, '100000.0::DOUBLE')}",
        "SELECT lat, lon FROM ringgeo", british_sql("pt", "vy, vx", "vy.p", "vx.p", "vy.idx AS y, vx.idx AS x, "), False, british_sql("ringgeo", "ring", "v", "u", "") + ", ",
    ),
)
def two_stage_british(spark, sf):
    g = grid(spark, sf)
    r = raster(spark, sf, g).withColumn("value", F.col("price"))
    ty, tx = ax.regular_axis(spark, 10, 0.0, 125000.0), ax.regular_axis(spark, 7, 0.0, 100000.0)
    return regrid.two_stage(r, *axes(spark, g), ty, tx, tgt_system="british").withColumn("value", F.round("value", 4))


@query(
    "jn10_same_grid",
    f"""WITH {RASTER}, {AXES} SELECT bool_and(abs(a.point - b.point) <= 1e-8 + 1e-10 * abs(b.point)
  AND abs(a.lo - b.lo) <= 1e-8 + 1e-10 * abs(b.lo) AND abs(a.hi - b.hi) <= 1e-8 + 1e-10 * abs(b.hi)) AS equal
FROM (SELECT y AS idx, min(-90 + (y + 0.5) * 180 / ny) AS point, min(-90 + y * 180.0 / ny) AS lo, min(-90 + (y + 1) * 180.0 / ny) AS hi FROM raster GROUP BY y) a
FULL JOIN ay b ON a.idx = b.idx""",
)
def same_grid(spark, sf):
    g = grid(spark, sf)
    found = raster(spark, sf, g).groupBy(F.col("y").alias("idx")).agg(
        F.min(F.lit(-90.0) + (F.col("y") + 0.5) * (180.0 / g.ny)).alias("point")
    )
    found = ax.guess_bounds(found).withColumn("axis", F.lit("y"))
    return regrid.same_grid(found, axes(spark, g)[0].withColumn("axis", F.lit("y")))


def displaced_weights(spark, sf, g):
    """Weights from the cells of a grid with a displaced pole to a regular grid, by clipped great-circle polygons."""
    cells = curved.corners_from_axes(*axes(spark, g), g.ny, g.nx)
    corners = F.zip_with("lats", "lons", lambda a, o: F.struct(*[c.alias(n) for c, n in zip(projection.from_rotated(a, o, 37.5, 177.5), ("a", "o"))]))
    cells = cells.select("cell", corners.alias("c")).selectExpr("cell", "transform(c, p -> p.a) AS lats", "transform(c, p -> p.o) AS lons")
    return curved.curved_weights(cells, curved.corners_from_axes(*odd_axes(spark), 17, 31))


@query("fn6_curved_weights")
def curved_weights(spark, sf):
    """The raster on the displaced grid, regridded to the regular one."""
    g = grid(spark, sf)
    r = raster(spark, sf, g).select((F.col("y").cast("long") * g.nx + F.col("x")).alias("src_cell"), "price")
    out = regrid.apply_weights(r, displaced_weights(spark, sf, g), value="price", normalise=True, digits=3)
    return out.select(F.col("tgt_cell").alias("cell"), F.col("price").alias("value"))


@query(
    "fn6_concave_cells",
    f"""WITH {RASTER}, {AXES}, a AS (SELECT r.y, r.x, r.price, tan(radians(ax.hi - ax.lo) / 2) AS k, sin(radians(ay.lo)) AS lo, sin(radians(ay.hi)) AS hi
  FROM raster r JOIN ay ON ay.idx = r.y JOIN ax ON ax.idx = r.x, dims WHERE r.y < dims.ny // 2 * 2 AND r.x < dims.nx // 2 * 2 AND (r.y % 2 = 0 OR r.x % 2 = 0))
SELECT y // 2 * 100000 + x // 2 AS cell, round(sum(price * (atan(k * hi) - atan(k * lo))) / sum(atan(k * hi) - atan(k * lo)), 3) AS value FROM a GROUP BY ALL""",
)
def concave_cells(spark, sf):
    """Each square of four cells less the one on its inner corner: L-shaped targets, whose overlaps are the areas of three cells."""
    g = grid(spark, sf)
    ay, axx = axes(spark, g)
    low, left = ay.filter("idx % 2 = 0"), axx.filter("idx % 2 = 0")
    tall = low.alias("a").join(ay.alias("b"), F.expr("b.idx = a.idx + 1")).selectExpr("a.idx DIV 2 AS j", "a.lo AS s0", "a.hi AS s1", "b.hi AS s2")
    wide = left.alias("a").join(axx.alias("b"), F.expr("b.idx = a.idx + 1")).selectExpr("a.idx DIV 2 AS i", "a.lo AS w0", "a.hi AS w1", "b.hi AS w2")
    blocks = spark.range((g.ny // 2) * (g.nx // 2)).selectExpr(f"id DIV {g.nx // 2} AS j", f"id % {g.nx // 2} AS i")
    shape = blocks.join(F.broadcast(tall), "j").join(F.broadcast(wide), "i")
    shape = shape.selectExpr("CAST(j * 100000 + i AS BIGINT) AS cell", "array(s0, s0, s0, s1, s1, s2, s2) AS lats", "array(w0, w1, w2, w2, w1, w1, w0) AS lons")
    weights = curved.curved_weights(curved.corners_from_axes(ay, axx, g.ny, g.nx), shape)
    r = raster(spark, sf, g).select((F.col("y").cast("long") * g.nx + F.col("x")).alias("src_cell"), "price")
    out = regrid.apply_weights(r, weights.filter("w > 1e-9"), value="price", normalise=True, digits=3)
    return out.select(F.col("tgt_cell").alias("cell"), F.col("price").alias("value"))
