"""End-to-end jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.functions.columns import nan
from gridloom.functions.legends import CCI_MEANINGS, CCI_VALUES
from gridloom.plans import jobs
from gridloom.session import materialise
from gridloom.sources import axes as ax
from workload.classes import FRACTIONS, WALK_SQL, fractions, walk
from workload.fixtures import (
    AXES, GASES, MONTH_AXES, MONTHLY, RASTER, RECORDS, axes, axis_sql, gases, grid, levels, month_axes, monthly, raster, read, records,
)
from workload.regions import OFF8, REACH, lakes, mouths, ocean
from workload.registry import query
from workload.regridding import HALF, ODD, coarse_axes, odd_axes, overlap_sql
from workload.series import SEG, WIDE, WIDE_SQL, YM, named_gases, with_months
from workload.surfaces import CHORD, FILL_SQL, INSIDE_SQL, outlines


@query(
    "jb1_general_regrid",
    f"""WITH {YM}, {MONTH_AXES}, {ODD}, {overlap_sql('wx', 'mx', 'ox', False)}, {overlap_sql('wy', 'my', 'oy', True)}
SELECT field_id, year, month, y, x, round(value, 6) AS value FROM (
  SELECT m.field_id, m.year, m.month, wy.t AS y, wx.t AS x, sum(value * wx.w * wy.w) / sum(wx.w * wy.w) AS value
  FROM ym m JOIN wx ON wx.s = m.x JOIN wy ON wy.s = m.y WHERE year BETWEEN 1996 AND 1999 GROUP BY ALL)""",
)
def general_regrid(spark, sf):
    out = jobs.general_regrid(
        with_months(spark, sf), month_axes(spark), odd_axes(spark), by=["field_id", "year", "month"], years=(1996, 1999)
    )
    return out.withColumn("value", F.round("value", 6))


#: Per column and row the nearest valid cells to either side, around the globe as well: no other cell of the row can be nearer.
DONORS = """donors AS MATERIALIZED (SELECT DISTINCT y, x, unnest([max(vx) OVER (PARTITION BY y ORDER BY x), min(vx) OVER (PARTITION BY y ORDER BY x DESC),
  min(vx) OVER (PARTITION BY y), max(vx) OVER (PARTITION BY y)]) AS vx FROM (SELECT y, x, CASE WHEN value IS NOT NULL THEN x END AS vx FROM p))"""


@query(
    "jb1_general_regrid_filled",
    f"""WITH {RASTER}, {AXES}, {HALF}, {overlap_sql('wx', 'ax', 'hx', False)}, {overlap_sql('wy', 'ay', 'hy', True)},
m AS MATERIALIZED (SELECT wy.t AS y, wx.t AS x, sum(value * wx.w * wy.w) / sum(CASE WHEN value IS NOT NULL THEN wx.w * wy.w END) AS value
  FROM (SELECT * REPLACE (CASE WHEN code <> 1 THEN value END AS value) FROM raster) r JOIN wx ON wx.s = r.x JOIN wy ON wy.s = r.y GROUP BY ALL),
p AS MATERIALIZED (SELECT hy.idx AS y, hx.idx AS x, m.value, (hy.idx // 5 + hx.idx // 4) % 2 AS land, hy.idx::BIGINT * (SELECT count(*) FROM hx) + hx.idx AS cell,
  cos(radians(hy.point)) * cos(radians(hx.point)) AS px, cos(radians(hy.point)) * sin(radians(hx.point)) AS py, sin(radians(hy.point)) AS pz
  FROM hy JOIN hx ON true LEFT JOIN m ON m.y = hy.idx AND m.x = hx.idx),
{DONORS},
best AS (SELECT m.cell, arg_min(v.value, ({CHORD}, v.cell)) AS value FROM p m JOIN donors d ON d.x = m.x JOIN p v ON v.y = d.y AND v.x = d.vx WHERE m.value IS NULL AND m.land = 1 GROUP BY m.cell)
SELECT y, x, round(CASE WHEN land = 1 THEN coalesce(p.value, b.value) END, 5) AS value FROM p LEFT JOIN best b ON b.cell = p.cell""",
)
def general_regrid_filled(spark, sf):
    g = grid(spark, sf)
    tgt = coarse_axes(spark, g)
    ny, nx = (f.n for f in ax.facts(*tgt))
    mask = spark.range(ny * nx).selectExpr(f"CAST(id DIV {nx} AS INT) AS y", f"CAST(id % {nx} AS INT) AS x").selectExpr("y", "x", "((y DIV 5) + (x DIV 4)) % 2 AS land")
    r = raster(spark, sf, g).select("y", "x", F.when(F.col("code") != 1, F.col("value")).alias("value"))
    return jobs.general_regrid(r, axes(spark, g), tgt, mask=mask, invert=True).withColumn("value", F.round("value", 5))


LEVEL_T = SEG.replace("(0, 90.0::DOUBLE), (1, 205.5::DOUBLE), (2, 380.0::DOUBLE), (3, 777.0::DOUBLE)", "(0, 150.0::DOUBLE), (1, 320.0::DOUBLE), (2, 610.0::DOUBLE)")


@query(
    "jb1_general_regrid_levels",
    f"""WITH {RASTER}, {LEVEL_T}, {AXES}, {HALF}, {overlap_sql('wx', 'ax', 'hx', False)}, {overlap_sql('wy', 'ay', 'hy', True)},
lv AS (SELECT y, x, level AS z, CASE WHEN hp IS NULL AND z < h THEN v WHEN h1 IS NULL OR z = h THEN v ELSE v + (z - h) / (h1 - h) * (v1 - v) END AS v FROM hit)
SELECT z, y, x, round(v, 5) AS value FROM (SELECT lv.z, wy.t AS y, wx.t AS x, sum(v * wx.w * wy.w) / sum(wx.w * wy.w) AS v FROM lv JOIN wx ON wx.s = lv.x JOIN wy ON wy.s = lv.y GROUP BY ALL)""",
)
def general_regrid_levels(spark, sf):
    g = grid(spark, sf)
    lv = levels(spark, sf, g)
    out = jobs.general_regrid(lv, axes(spark, g), coarse_axes(spark, g), by=["z"], heights=[150.0, 320.0, 610.0])
    return out.withColumn("value", F.round("value", 5))


@query(
    "jb2_fill_and_merge",
    f"""WITH {FILL_SQL}, a AS (SELECT y, x, coalesce(value, CASE WHEN code <> 2 THEN -price END) AS v, land FROM raster),
m AS (SELECT p.y, p.x, p.cell, p.px, p.py, p.pz, a.v AS value, p.land FROM p LEFT JOIN (SELECT r.y, r.x, CASE WHEN r.y < 40 AND code <> 6 THEN value ELSE CASE WHEN code <> 2 THEN -price END END AS v FROM raster r) a ON a.y = p.y AND a.x = p.x),
best AS (SELECT m.cell, arg_min(v.value, ({CHORD}, v.cell)) AS value FROM m, m v WHERE m.value IS NULL AND m.land = 1 AND v.value IS NOT NULL GROUP BY m.cell)
SELECT m.y, m.x, CASE WHEN m.land = 1 THEN coalesce(m.value, b.value) END AS value FROM m LEFT JOIN best b ON b.cell = m.cell JOIN raster r ON r.y = m.y AND r.x = m.x""",
)
def fill_and_merge(spark, sf):
    g = grid(spark, sf)
    r = raster(spark, sf, g)
    primary = r.filter("y < 40").select("y", "x", F.when(F.col("code") == 6, nan()).otherwise(F.col("value")).alias("value"))
    alternate = r.select("y", "x", F.when(F.col("code") != 2, -F.col("price")).alias("value"))
    return jobs.fill_and_merge(primary, alternate, axes(spark, g), mask=r.select("y", "x", "land"), invert=True)


@query(
    "jb2_fill_and_merge_outline",
    f"""WITH {INSIDE_SQL}, p AS (SELECT r.y, r.x, r.land, CAST(r.y AS BIGINT) * nx + r.x AS cell, cos(radians(ay.point)) * cos(radians(ax.point)) AS px,
    cos(radians(ay.point)) * sin(radians(ax.point)) AS py, sin(radians(ay.point)) AS pz, CASE WHEN inside THEN value ELSE -price END AS value
  FROM raster r JOIN ins ON ins.y = r.y AND ins.x = r.x JOIN ay ON ay.idx = r.y JOIN ax ON ax.idx = r.x),
best AS (SELECT m.cell, arg_min(v.value, ({CHORD}, v.cell)) AS value FROM p m, p v WHERE m.value IS NULL AND m.land = 1 AND v.value IS NOT NULL GROUP BY m.cell)
SELECT y, x, CASE WHEN land = 1 THEN coalesce(p.value, b.value) END AS value FROM p LEFT JOIN best b ON b.cell = p.cell""",
)
def fill_and_merge_outline(spark, sf):
    g = grid(spark, sf)
    r = raster(spark, sf, g)
    return jobs.fill_and_merge(
        r.select("y", "x", "value"), r.select("y", "x", (-F.col("price")).alias("value")), axes(spark, g), outlines(spark), r.select("y", "x", "land"), invert=True
    )


def land_cover(spark, sf):
    g = grid(spark, sf)
    return jobs.land_cover(raster(spark, sf, g).select("y", "x", "code"), axes(spark, g), coarse_axes(spark, g), walk(spark))


COVER = f"""{RASTER}, {AXES}, {HALF}, {WALK_SQL}, {overlap_sql('wx', 'ax', 'hx', False)}, {overlap_sql('wy', 'ay', 'hy', True)},
raw AS (SELECT wy.t AS y, wx.t AS x, target_type AS pl, sum(pct * wx.w * wy.w) / sum(wx.w * wy.w) / 100 AS c FROM raster r JOIN wx ON wx.s = r.x JOIN wy ON wy.s = r.y JOIN walk USING (code) GROUP BY ALL),
one AS (SELECT y, x, pl, c / sum(c) OVER (PARTITION BY y, x) AS v FROM raw),
icy AS (SELECT *, max(v) FILTER (pl = 9) OVER (PARTITION BY y, x) AS ice FROM one),
cut AS (SELECT y, x, pl, CASE WHEN ice >= 0.5 THEN CASE WHEN pl = 9 THEN 1.0 ELSE 0 END WHEN pl = 9 THEN 0 ELSE v END AS c FROM icy),
two AS (SELECT y, x, pl, c / sum(c) OVER (PARTITION BY y, x) AS v FROM cut),
i AS (SELECT y, x, (SELECT count(*) FROM hx) AS nx, v AS ice, CAST(y AS BIGINT) * (SELECT count(*) FROM hx) + x AS cell FROM two WHERE pl = 9),
core AS (SELECT a.cell FROM i a JOIN i b ON b.y BETWEEN a.y - 2 AND a.y + 2 AND (b.x - a.x + 2 + a.nx) % a.nx <= 4 GROUP BY a.cell HAVING count_if(b.ice = 1) = count(*)),
c AS (SELECT * FROM i WHERE ice = 1), {OFF8},
links AS (SELECT a.cell AS a, b.cell AS b FROM c a, off JOIN c b ON b.y = a.y + dy AND b.x = (a.x + dx + a.nx) % a.nx), {REACH},
lost AS (SELECT y, x FROM i WHERE ice > 0 AND cell NOT IN (SELECT cell FROM lab WHERE region IN (SELECT region FROM lab JOIN core USING (cell)))),
three AS (SELECT y, x, pl, CASE WHEN (y, x) IN (SELECT (y, x) FROM lost) THEN CASE pl WHEN 9 THEN 0 WHEN 8 THEN 1 ELSE v END ELSE v END AS v FROM two),
sea AS (SELECT *, max(v) FILTER (pl = 0) OVER (PARTITION BY y, x) AS sea FROM three),
dry AS (SELECT *, CASE WHEN sea < 0.5 AND pl = 0 THEN 0 ELSE v END AS d FROM sea),
four AS (SELECT y, x, pl, sea, CASE WHEN sum(d) OVER (PARTITION BY y, x) = 0 THEN d ELSE d / sum(d) OVER (PARTITION BY y, x) END AS v FROM dry)"""


@query("jb3_land_cover_fractions", f"WITH RECURSIVE {COVER} SELECT y, x, pl, round(CASE WHEN sea < 0.5 THEN v END, 8) AS value FROM four WHERE pl > 0")
def land_cover_fractions(spark, sf):
    return land_cover(spark, sf)[0].withColumn("value", F.round("value", 8))


LCF = f"""{RASTER}, {AXES}, {HALF}, {WALK_SQL}, {overlap_sql('wx', 'ax', 'hx', False)}, {overlap_sql('wy', 'ay', 'hy', True)},
c AS (SELECT wy.t AS y, wx.t AS x, target_type AS pl, sum(pct * wx.w * wy.w) AS c FROM raster r JOIN wx ON wx.s = r.x JOIN wy ON wy.s = r.y JOIN walk USING (code) GROUP BY ALL)"""


@query("jb3_land_mask", f"WITH RECURSIVE {COVER} SELECT y, x, CASE WHEN sea < 0.5 THEN 1 ELSE 0 END AS land FROM four WHERE pl = 0")
def land_cover_mask(spark, sf):
    return land_cover(spark, sf)[1]


@query("jb3_land_fraction", f"WITH {LCF} SELECT y, x, round(1 - sum(c) FILTER (pl = 0) / sum(c), 8) AS value FROM c GROUP BY y, x")
def land_fraction(spark, sf):
    return land_cover(spark, sf)[2].withColumn("value", F.round("value", 8))


@query(
    "jb4_c4_injection",
    f"""WITH {FRACTIONS}, {AXES}, {MONTH_AXES}, {overlap_sql('wx', 'mx', 'ax', False)}, {overlap_sql('wy', 'my', 'ay', True)},
s AS (SELECT CAST(l_partkey % 36 AS INT) AS y, CAST(l_orderkey % 72 AS INT) AS x, avg(l_quantity) AS v FROM lineitem GROUP BY ALL),
g AS (SELECT wy.t AS y, wx.t AS x, sum(v * wx.w * wy.w) / sum(wx.w * wy.w) AS v FROM s JOIN wx ON wx.s = s.x JOIN wy ON wy.s = s.y GROUP BY ALL),
p AS (SELECT ay.idx AS y, ax.idx AS x, g.v AS value, CAST(ay.idx AS BIGINT) * nx + ax.idx AS cell, cos(radians(ay.point)) * cos(radians(ax.point)) AS px,
  cos(radians(ay.point)) * sin(radians(ax.point)) AS py, sin(radians(ay.point)) AS pz FROM ay JOIN ax ON true JOIN dims ON true LEFT JOIN g ON g.y = ay.idx AND g.x = ax.idx),
best AS (SELECT m.cell, arg_min(v.value, ({CHORD}, v.cell)) AS value FROM p m, p v WHERE m.value IS NULL AND v.value IS NOT NULL GROUP BY m.cell),
c4 AS (SELECT y, x, coalesce(p.value, b.value) / 100 AS c FROM p LEFT JOIN best b ON b.cell = p.cell),
f AS (SELECT * FROM fr WHERE pl <> 4), m AS (SELECT f.y, f.x, value AS c3, least(c, value) AS moved FROM f JOIN c4 ON c4.y = f.y AND c4.x = f.x WHERE pl = 3)
SELECT f.y, f.x, pl, round(CASE WHEN pl = 3 THEN c3 - moved ELSE value END, 7) AS value FROM f LEFT JOIN m ON m.y = f.y AND m.x = f.x
UNION ALL SELECT y, x, 4, round(moved, 7) FROM m""",
)
def c4_injection(spark, sf):
    f = materialise(fractions(spark, sf).filter("pl <> 4"))
    f = f.unionByName(f.filter("pl = 3").withColumn("pl", F.lit(4)).withColumn("value", F.lit(0.0)))
    g = grid(spark, sf)
    c4 = read(spark, sf, "lineitem").groupBy(F.expr("CAST(l_partkey % 36 AS INT)").alias("y"), F.expr("CAST(l_orderkey % 72 AS INT)").alias("x")).agg(F.avg("l_quantity").alias("value"))
    return jobs.c4_injection(f, c4, month_axes(spark), axes(spark, g)).withColumn("value", F.round("value", 7))


CCI = "cci AS (SELECT * FROM (VALUES " + ", ".join(f"({v}, '{n}')" for v, n in zip(CCI_VALUES, CCI_MEANINGS.split())) + ") t(code, flag_meaning))"


def lakes_sql(name, lakes, cells, water, target):
    """Cells as table `name`, the regions of code `water` around the seeds of `lakes` recoded; a box of three cells to each side."""
    return f"""{name}_ys AS (SELECT lake, idx AS y, arg_min(idx, (round(abs(point - lat), 9), idx)) OVER (PARTITION BY lake) AS sy, count(*) OVER (PARTITION BY lake) AS n FROM {lakes}, ay, dims WHERE hi > lat - 540.0::DOUBLE / ny AND lo < lat + 540.0::DOUBLE / ny),
{name}_xs AS (SELECT lake, idx AS x, arg_min(idx, (round(abs(point - lon), 9), idx)) OVER (PARTITION BY lake) AS sx, count(*) OVER (PARTITION BY lake) AS n FROM {lakes}, ax, dims WHERE hi > lon - 1080.0::DOUBLE / nx AND lo < lon + 1080.0::DOUBLE / nx),
{name}_part AS MATERIALIZED (SELECT xs.lake, r.y, r.x, sy, sx FROM {cells} r JOIN {name}_ys ys ON ys.y = r.y JOIN {name}_xs xs ON xs.lake = ys.lake AND xs.x = r.x WHERE ys.n > 1 AND xs.n > 1 AND code = {water}),
{name}_fill AS (SELECT lake, y, x FROM {name}_part WHERE y = sy AND x = sx UNION
  SELECT p.lake, p.y, p.x FROM {name}_fill f, off4 JOIN {name}_part p ON p.lake = f.lake AND p.y = f.y + dy AND p.x = f.x + dx),
{name} AS MATERIALIZED (SELECT c.y, c.x, CASE WHEN h.y IS NULL THEN code ELSE {target} END AS code FROM {cells} c LEFT JOIN (SELECT DISTINCT y, x FROM {name}_fill) h ON h.y = c.y AND h.x = c.x)"""


@query(
    "jb5_prepare_fine_classes",
    f"""WITH RECURSIVE {RASTER}, {AXES}, {MONTH_AXES}, {CCI}, off4 AS (SELECT * FROM (VALUES (0, 1), (0, -1), (1, 0), (-1, 0)) t(dy, dx)),
lakes AS (SELECT c_custkey AS lake, (c_acctbal - 4500) / 62 AS lat, CAST(c_custkey % 350 - 175 AS DOUBLE) + 0.3 AS lon FROM customer),
up AS (SELECT * FROM lakes WHERE lat > 0), down AS (SELECT * FROM lakes WHERE lat <= 0),
seg AS (SELECT idx AS s0, (idx + 1) % 72 AS s1, point AS p0, point + 5 AS p1 FROM mx),
snow AS (SELECT ax.idx AS x, ((s0 // 9) % 2 = 0)::INT * (1 - (p - p0) / 5) + ((s1 // 9) % 2 = 0)::INT * ((p - p0) / 5) AS v
  FROM (SELECT idx, CASE WHEN point < -177.5 THEN point + 360 ELSE point END AS p FROM ax) ax JOIN seg ON p >= p0 AND p < p1),
raw AS MATERIALIZED (SELECT r.y, r.x, CASE WHEN ay.point < -60 THEN CASE WHEN snow.v > 0.5 THEN -36 ELSE -45 END WHEN priority <> '5-LOW' THEN CASE WHEN code = 3 THEN -46 ELSE code END END AS code,
  CAST(r.y AS BIGINT) * nx + r.x AS cell, cos(radians(ay.point)) * cos(radians(ax.point)) AS px, cos(radians(ay.point)) * sin(radians(ax.point)) AS py, sin(radians(ay.point)) AS pz
  FROM raster r JOIN ay ON ay.idx = r.y JOIN ax ON ax.idx = r.x JOIN snow ON snow.x = r.x),
best AS (SELECT m.cell, arg_min(v.code, ({CHORD}, v.cell)) AS code FROM raw m, raw v WHERE m.code IS NULL AND v.code IS NOT NULL GROUP BY m.cell),
full_ AS MATERIALIZED (SELECT raw.y, raw.x, coalesce(raw.code, best.code) AS code FROM raw LEFT JOIN best ON best.cell = raw.cell),
{lakes_sql('sea', 'down', 'full_', -46, -45)}, {lakes_sql('fresh', 'up', 'sea', -46, -47)}
SELECT y, x, f.code::INT AS code, flag_meaning FROM fresh f LEFT JOIN cci ON cci.code = f.code""",
)
def prepare_fine_classes(spark, sf):
    g = grid(spark, sf)
    codes = raster(spark, sf, g).select("y", "x", F.when(F.col("priority") != "5-LOW", F.when(F.col("code") == 3, -46).otherwise(F.col("code"))).alias("code"))
    polar = spark.range(36 * 72).selectExpr("CAST(id DIV 72 AS INT) AS y", "CAST(id % 72 AS INT) AS x").selectExpr("y", "x", "IF((x DIV 9) % 2 = 0, 15, 0) AS code")
    every = lakes(spark, sf, g)
    out, _, _ = jobs.prepare_fine_classes(codes, axes(spark, g), polar, month_axes(spark), every.filter("lat > 0"), every.filter("lat <= 0"))
    return out.select("y", "x", "code", "flag_meaning")


@query(
    "jb6_prepare_coarse_classes",
    f"""WITH {FILL_SQL}, b AS (SELECT p.y, p.x, p.cell, px, py, pz, CASE WHEN o.status = 'F' AND o.land = 0 THEN 0 ELSE CASE WHEN r.priority <> '5-LOW' THEN r.code END END AS code
  FROM p LEFT JOIN raster r ON r.y = p.y AND r.x = p.x LEFT JOIN raster o ON o.y = p.y AND o.x = p.x),
best AS (SELECT m.cell, arg_min(v.code, ({CHORD}, v.cell)) AS code FROM b m, b v WHERE m.code IS NULL AND v.code IS NOT NULL GROUP BY m.cell),
n AS (SELECT unnest(['ocean', 'evergreen_needleleaf_forest', 'evergreen_broadleaf_forest', 'deciduous_needleleaf_forest', 'deciduous_broadleaf_forest', 'mixed_forest', 'closed_shrublands']) AS flag_meaning, unnest(range(7))::INT AS code)
SELECT b.y, b.x, n.code, flag_meaning FROM b JOIN raster r ON r.y = b.y AND r.x = b.x LEFT JOIN best ON best.cell = b.cell JOIN n ON n.code = coalesce(b.code, best.code)""",
)
def prepare_coarse_classes(spark, sf):
    g = grid(spark, sf)
    r = raster(spark, sf, g)
    codes = r.select("y", "x", F.when(F.col("priority") != "5-LOW", F.col("code")).alias("code"))
    climate = r.select("y", "x", F.when((F.col("status") == "F") & (F.col("land") == 0), 15).otherwise(1).alias("code"))
    return jobs.prepare_coarse_classes(codes, climate, axes(spark, g)).select("y", "x", "code", "flag_meaning")


@query(
    "jb7_prepare_national_classes",
    f"""WITH {RASTER}, n AS (SELECT unnest(['sea_or_estuary', 'inland_water', 'beach_and_coastal_bare', 'saltmarsh', 'grass_heath', 'mown_or_grazed_turf', 'meadow_or_verge_meadow_or_verge_or_semi-natural']) AS flag_meaning, unnest(range(1, 8)) AS k)
SELECT y, x, code + 1 AS code, flag_meaning FROM raster JOIN n ON k = code + 1""",
)
def prepare_national_classes(spark, sf):
    r = raster(spark, sf).select("y", "x", (F.col("code") + 1).alias("code"))
    return jobs.prepare_national_classes([r.filter("y < 30"), r.filter("y >= 30")]).select("y", "x", "code", "flag_meaning")


@query("jb8_masks", f"WITH {RASTER}, f AS (SELECT y, x, CASE WHEN code = 5 THEN NULL WHEN status = 'F' THEN 0.0 WHEN status = 'O' THEN 1.0 ELSE price / 1e6 END AS v FROM raster) SELECT y, x, CASE WHEN v IS NULL THEN -1 WHEN v > 0 THEN 1 ELSE 0 END AS land_mask, CASE WHEN v IS NULL THEN -1 WHEN v < 1 THEN 0 ELSE 1 END AS sea_mask FROM f")
def masks(spark, sf):
    v = F.when(F.col("code") == 5, None).when(F.col("status") == "F", 0.0).when(F.col("status") == "O", 1.0).otherwise(F.col("price") / 1e6)
    return jobs.masks(raster(spark, sf).select("y", "x", v.alias("value")))


@query(
    "jb9_add_lakes",
    f"""WITH {RASTER}, {AXES}, {HALF},
wx AS (SELECT o.idx AS t, arg_max(a.idx, (-round(least(abs(a.point - o.point), 360 - abs(a.point - o.point)), 9), a.idx)) AS s FROM ax a, hx o GROUP BY ALL),
wy AS (SELECT o.idx AS t, arg_max(a.idx, (-round(abs(a.point - o.point), 9), a.idx)) AS s FROM ay a, hy o GROUP BY ALL)
SELECT hy.idx AS y, hx.idx AS x, CASE WHEN r.code = 2 THEN 0 ELSE 1 END AS land FROM hy JOIN hx ON true JOIN wx ON wx.t = hx.idx JOIN wy ON wy.t = hy.idx LEFT JOIN raster r ON r.y = wy.s AND r.x = wx.s""",
)
def add_lakes(spark, sf):
    g = grid(spark, sf)
    tgt = coarse_axes(spark, g)
    ny, nx = (f.n for f in ax.facts(*tgt))
    land = spark.range(ny * nx).selectExpr(f"CAST(id DIV {nx} AS INT) AS y", f"CAST(id % {nx} AS INT) AS x", "1 AS land")
    return jobs.add_lakes(land, tgt, raster(spark, sf, g).select("y", "x", "code"), axes(spark, g), 2)


@query(
    "jb10_river_routing",
    f"""WITH {RASTER}, {AXES}, {HALF}, {overlap_sql('wx', 'ax', 'hx', False)}, {overlap_sql('wy', 'ay', 'hy', True)},
h AS (SELECT (SELECT count(*) FROM hy) AS hny, (SELECT count(*) FROM hx) AS hnx),
f AS (SELECT wy.t AS y, wx.t AS x, sum(land * wx.w * wy.w) / sum(wx.w * wy.w) AS lcf FROM raster r JOIN wx ON wx.s = r.x JOIN wy ON wy.s = r.y GROUP BY ALL),
d AS (SELECT y, x, lcf, CASE WHEN lcf <= 0 THEN 9 ELSE 1 + (y * 5 + x * 3) % 8 END AS code FROM f),
t AS (SELECT DISTINCT (y + CASE WHEN code IN (1, 2, 8) THEN -1 WHEN code IN (4, 5, 6) THEN 1 ELSE 0 END + hny) % hny AS y,
  (x + CASE WHEN code IN (2, 3, 4) THEN 1 WHEN code IN (6, 7, 8) THEN -1 ELSE 0 END + hnx) % hnx AS x FROM d, h WHERE code BETWEEN 1 AND 8)
SELECT d.y, d.x, CASE WHEN lcf = 0 AND t.y IS NULL THEN NULL ELSE code END AS code, CASE WHEN lcf = 0 AND t.y IS NULL THEN NULL ELSE (d.y + d.x) % 40 END AS sequence FROM d LEFT JOIN t ON t.y = d.y AND t.x = d.x""",
)
def river_routing(spark, sf):
    g = grid(spark, sf)
    tgt = coarse_axes(spark, g)
    ny, nx = (f.n for f in ax.facts(*tgt))
    d = spark.range(ny * nx).selectExpr(f"CAST(id DIV {nx} AS INT) AS y", f"CAST(id % {nx} AS INT) AS x").selectExpr("y", "x", "1 + (y * 5 + x * 3) % 8 AS code", "(y + x) % 40 AS sequence")
    land = raster(spark, sf, g).select("y", "x", F.col("land").cast("double").alias("value"))
    return jobs.river_routing(d, land, axes(spark, g), tgt)


def numbered(spark, sf):
    g = grid(spark, sf)
    o = ocean(spark, sf, g)
    flow = raster(spark, sf, g).select("y", "x", (F.col("price") / 1e6).alias("r"))
    return jobs.river_numbers(flow, o.select("y", "x", "nav_lat", "nav_lon"), o.select("y", "x", "sea"), mouths(spark, sf), g.ny, g.nx, 0.15)


@query("jb10_river_numbers_ocean")
def river_numbers_ocean(spark, sf):
    return numbered(spark, sf)[0]


@query("jb10_river_numbers_blank")
def river_numbers_blank(spark, sf):
    """Without runoff every number is a mouth's own or one it found."""
    g = grid(spark, sf)
    o = ocean(spark, sf, g)
    none = raster(spark, sf, g).select("y", "x", F.col("price").alias("r")).limit(0)
    return jobs.river_numbers(none, o.select("y", "x", "nav_lat", "nav_lon"), o.select("y", "x", "sea"), mouths(spark, sf), g.ny, g.nx, 0.15)[1]


@query("jb11_prepare_routing_records", f"WITH {RECORDS} SELECT *, CAST(dense_rank() OVER (PARTITION BY file, stash ORDER BY yr, mon, dat) - 1 AS INT) AS t FROM (SELECT * REPLACE (CASE WHEN datd = 31 THEN 30 ELSE datd END AS datd, 2 AS tim) FROM records) WHERE stash = 1003 AND model IN (1, 0)")
def prepare_routing_records(spark, sf):
    return jobs.prepare_river_records(records(spark, sf).withColumn("tim", F.lit(2)), ["file"], 1, 3, storage=False)


@query(
    "jb12_river_storage",
    f"""WITH {MONTHLY}, {MONTH_AXES}, {ODD}, {overlap_sql('wx', 'mx', 'ox', False)}, {overlap_sql('wy', 'my', 'oy', True)}
SELECT field_id, t, y, x, CASE WHEN (y + x) % 3 <> 0 THEN round(value, 6) END AS value FROM (
  SELECT m.field_id, m.t, wy.t AS y, wx.t AS x, sum(value * wx.w * wy.w) / sum(wx.w * wy.w) AS value FROM monthly m JOIN wx ON wx.s = m.x JOIN wy ON wy.s = m.y GROUP BY ALL)""",
)
def river_storage(spark, sf):
    d = spark.range(17 * 31).selectExpr("CAST(id DIV 31 AS INT) AS y", "CAST(id % 31 AS INT) AS x").selectExpr("y", "x", "IF((y + x) % 3 <> 0, 1, NULL) AS code")
    out = jobs.river_storage(monthly(spark, sf), month_axes(spark), odd_axes(spark), d, ["field_id", "t"])
    return out.withColumn("value", F.round("value", 6))


@query("jb13_prepare_storage_records", f"""WITH {RECORDS}, r AS (SELECT * REPLACE (CASE WHEN model = 0 THEN 0 ELSE datd END AS datd, 2 AS tim) FROM records),
m AS (SELECT * REPLACE (CASE WHEN datd = 0 THEN 22 ELSE tim END AS tim, CASE WHEN datd = 0 THEN 1 ELSE datd END AS datd, CASE WHEN datd = 0 THEN 1950 ELSE yr END AS yr,
  CASE WHEN datd = 0 THEN CASE WHEN mond = 12 THEN 1951 ELSE 1950 END ELSE yrd END AS yrd, CASE WHEN datd = 0 THEN mond % 12 + 1 ELSE mond END AS mond) FROM r WHERE stash = 1003 AND model IN (1, 0))
SELECT *, CAST(dense_rank() OVER (PARTITION BY file, stash ORDER BY yr, mon, dat) - 1 AS INT) AS t FROM m""")
def prepare_storage_records(spark, sf):
    r = records(spark, sf).withColumn("tim", F.lit(2)).withColumn("datd", F.when(F.col("model") == 0, 0).otherwise(F.col("datd")))
    return jobs.prepare_river_records(r, ["file"], 1, 3, storage=True)


@query(
    "jb14_topographic_index",
    f"""WITH {RASTER}, {AXES}, {HALF}, {overlap_sql('wx', 'ax', 'hx', False)}, {overlap_sql('wy', 'ay', 'hy', True)},
sums AS MATERIALIZED (SELECT wy.t AS y, wx.t AS x, sum(value * wx.w * wy.w) AS a, sum(value * value * wx.w * wy.w) AS b, sum(CASE WHEN value IS NOT NULL THEN wx.w * wy.w END) AS w
  FROM (SELECT * REPLACE (CASE WHEN code <> 1 THEN value END AS value) FROM raster) r JOIN wx ON wx.s = r.x JOIN wy ON wy.s = r.y GROUP BY ALL),
p AS MATERIALIZED (SELECT hy.idx AS y, hx.idx AS x, a / w AS value, sqrt(abs(b / w - (a / w) * (a / w))) AS stdev, (hy.idx + hx.idx) % 11 = 0 AS gone, (hy.idx + hx.idx) % 11 <> 0 AND hy.idx % 6 = 0 AS ice,
  hy.idx::BIGINT * (SELECT count(*) FROM hx) + hx.idx AS cell, cos(radians(hy.point)) * cos(radians(hx.point)) AS px, cos(radians(hy.point)) * sin(radians(hx.point)) AS py, sin(radians(hy.point)) AS pz
  FROM hy JOIN hx ON true LEFT JOIN sums s ON s.y = hy.idx AND s.x = hx.idx),
{DONORS},
best AS (SELECT m.cell, arg_min(v.cell, ({CHORD}, v.cell)) AS src FROM p m JOIN donors d ON d.x = m.x JOIN p v ON v.y = d.y AND v.x = d.vx WHERE m.value IS NULL AND NOT m.gone AND NOT m.ice GROUP BY m.cell)
SELECT p.y, p.x, round(CASE WHEN p.ice THEN 0 WHEN NOT p.gone THEN coalesce(p.value, d.value) END, 5) AS value, round(CASE WHEN p.ice THEN 0 WHEN NOT p.gone THEN coalesce(p.stdev, d.stdev) END, 4) AS stdev
FROM p LEFT JOIN best b ON b.cell = p.cell LEFT JOIN p d ON d.cell = b.src""",
)
def topographic_index(spark, sf):
    g = grid(spark, sf)
    index = raster(spark, sf, g).select("y", "x", F.when(F.col("code") != 1, F.col("value")).alias("value"))
    tgt = coarse_axes(spark, g)
    ny, nx = (f.n for f in ax.facts(*tgt))
    ice = spark.range(ny * nx).selectExpr(f"CAST(id DIV {nx} AS INT) AS y", f"CAST(id % {nx} AS INT) AS x", "9 AS pl").selectExpr("y", "x", "pl", "IF((y + x) % 11 = 0, NULL, IF(y % 6 = 0, 1D, 0D)) AS value")
    out = jobs.topographic_index(index, axes(spark, g), tgt, ice)
    return out.select("y", "x", F.round("value", 5).alias("value"), F.round("stdev", 4).alias("stdev"))


@query("jb15_prepare_topographic_index", f"WITH {RASTER} SELECT y, x, nullif(CASE WHEN code = 4 THEN -1 ELSE value END, -1) AS value FROM raster")
def prepare_topographic_index(spark, sf):
    g = grid(spark, sf)
    r = raster(spark, sf, g).select("y", "x", F.when(F.col("code") == 4, -1.0).otherwise(F.col("value")).alias("value"))
    return jobs.prepare_topographic_index(r, axes(spark, g))[0]


@query("jb16_convert_records", f"""WITH {RECORDS} SELECT file, seq, greatest(proc, 0) AS proc, CAST(row_number() OVER (PARTITION BY file ORDER BY yr, mon, dat, f, model, seq) AS INT) AS pos FROM (SELECT *, min(seq) OVER (PARTITION BY file, stash) AS f FROM records)""")
def convert_records(spark, sf):
    out = jobs.convert_records(records(spark, sf).withColumnRenamed("model", "lev"), ["file"], ["yr", "mon", "dat"])
    return out.select("file", "seq", "proc", "pos")


@query(
    "jb17_radiation_listing",
    f"""WITH {GASES}, q AS (SELECT gas, CAST(floor(1850 + days / 365) AS INT) AS year, value * f * u AS v FROM (SELECT * REPLACE (days + 365 * 22 AS days) FROM gases)
  JOIN (VALUES ('CO2', 1.5188::DOUBLE, 1e-6::DOUBLE), ('CH4', 0.5523::DOUBLE, 1e-9::DOUBLE), ('N2O', 1.5188::DOUBLE, 1e-9::DOUBLE), ('CFC12', 4.1783::DOUBLE, 1e-12::DOUBLE), ('HFC134A', 3.5219::DOUBLE, 1e-12::DOUBLE)) k(g, f, u) ON g = gas WHERE sector = 0),
w AS (SELECT *, lag(v) OVER w AS u, lead(v) OVER w AS n FROM q WINDOW w AS (PARTITION BY gas ORDER BY year)),
s AS (SELECT * FROM (SELECT gas, year, coalesce(0.5::DOUBLE * (u + v), v) AS value FROM w UNION ALL SELECT gas, year + 1, v + 0.5::DOUBLE * (v - u) FROM w WHERE n IS NULL) WHERE year BETWEEN 2017 AND 2024),
n AS (SELECT *, row_number() OVER (PARTITION BY gas ORDER BY year) AS rn, count(*) OVER (PARTITION BY gas) AS n FROM s),
t AS (SELECT 'levls' AS section, gas, CAST((rn - 1) // 6 AS INT) AS line, string_agg(printf('%.4e', value), ',' ORDER BY rn) || CASE WHEN max(rn) < max(n) THEN ',' ELSE '' END AS x FROM n GROUP BY ALL
  UNION ALL SELECT 'years', gas, CAST((rn - 1) // 12 AS INT), string_agg(CAST(year AS VARCHAR), ',' ORDER BY rn) || CASE WHEN max(rn) < max(n) THEN ',' ELSE '' END FROM n GROUP BY gas, (rn - 1) // 12),
c AS (SELECT gas, count(*) AS n FROM s GROUP BY gas), i AS (SELECT max(n) AS n, g FROM c, (SELECT unnest(['CFC11', 'SO4']) AS g) GROUP BY g)
SELECT section, gas, line, CASE WHEN line = 0 THEN 'clim_fcg_' || section || '_' || lower(gas) || '=' ELSE '    =' END || x AS text FROM t
UNION ALL SELECT 'nyears', gas, 0, 'clim_fcg_nyears_' || lower(gas) || '=' || n FROM c UNION ALL SELECT 'rates', gas, 0, 'clim_fcg_rates_' || lower(gas) || '=' || n || '*-32768.0' FROM c
UNION ALL SELECT 'levls', g, 0, 'clim_fcg_levls_' || lower(g) || '=' || n || '*-32768.0' FROM i UNION ALL SELECT 'nyears', g, 0, 'clim_fcg_nyears_' || lower(g) || '=0' FROM i
UNION ALL SELECT 'rates', g, 0, 'clim_fcg_rates_' || lower(g) || '=' || n || '*-32768.0' FROM i UNION ALL SELECT 'years', g, 0, 'clim_fcg_years_' || lower(g) || '=' || n || '*-32768' FROM i""",
)
def radiation_listing(spark, sf):
    g = gases(spark, sf).withColumn("days", F.col("days") + 365 * 22)
    return jobs.radiation_listing(g, "scenario", 2017, 2024, ["CFC11", "SO4"])


@query("jb18_chemistry_table", f"WITH {WIDE_SQL} SELECT year, c12 * -1e6 AS DUMM0, co2 AS CO2, ch4 AS CH4, n2o AS N2O, c12 AS CFC_12, h AS HALON1211, h * 0 AS HALON1202 FROM wide WHERE sector = 0 AND year BETWEEN 1996 AND 2000")
def chemistry_table(spark, sf):
    return jobs.chemistry_table(named_gases(spark, sf), 1996, 2000, WIDE)


@query(
    "jb19_nitrogen_deposition",
    f"""WITH s AS (SELECT l_linestatus AS field_id, CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month, CAST(l_partkey % 36 AS INT) AS y, CAST(l_orderkey % 72 AS INT) AS x, sum(l_quantity - 20) AS v FROM lineitem GROUP BY ALL),
tot AS (SELECT year, month, y, x, sum(v) AS v FROM s GROUP BY ALL HAVING count(*) = 2),
p AS (SELECT year, month, y, x, v FROM tot WHERE year BETWEEN 1996 AND 1999 AND year NOT IN (1996, 1999) UNION ALL SELECT 1996, month, y, x, v FROM tot WHERE year = 1997 UNION ALL SELECT 1999, month, y, x, v FROM tot WHERE year = 1998),
n AS (SELECT *, CAST((dense_rank() OVER (ORDER BY year, month) - 1) * 30 + 15 AS INT) AS days FROM p),
{MONTH_AXES}, {ODD}, {overlap_sql('wx', 'mx', 'ox', False)}, {overlap_sql('wy', 'my', 'oy', True)}
SELECT CAST(year AS INT) AS year, month, days, y, x, CASE WHEN value < 0 THEN 0 ELSE round(value, 5) END AS value FROM (
  SELECT year, month, days, wy.t AS y, wx.t AS x, sum(v * wx.w * wy.w) / sum(wx.w * wy.w) AS value FROM n JOIN wx ON wx.s = n.x JOIN wy ON wy.s = n.y GROUP BY ALL)""",
)
def nitrogen_deposition(spark, sf):
    """Two species on the whole five-degree grid."""
    s = read(spark, sf, "lineitem").groupBy(
        F.col("l_linestatus").alias("field_id"), F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"),
        F.expr("CAST(l_partkey % 36 AS INT)").alias("y"), F.expr("CAST(l_orderkey % 72 AS INT)").alias("x"),
    ).agg(F.sum(F.col("l_quantity") - 20).alias("value"))
    out = jobs.nitrogen_deposition(s, month_axes(spark), odd_axes(spark), 1996, 1999, pad=(1997, 1998), n_species=2)
    return out.withColumn("value", F.round("value", 5))
