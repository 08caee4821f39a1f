"""Connected regions, lakes, rivers."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.operators import regions as rg
from gridloom.operators import rivers as rv
from gridloom.operators.regrid import complete
from gridloom.sinks.writers import ocean_river_table
from gridloom.session import materialise
from workload.fixtures import AXES, RASTER, axes, grid, raster, read
from workload.registry import query

OFF8 = "off AS (SELECT dy, dx FROM (SELECT unnest([-1, 0, 1]) AS dy), (SELECT unnest([-1, 0, 1]) AS dx) WHERE dy <> 0 OR dx <> 0)"
OFF4 = "off AS (SELECT unnest([-1, 1, 0, 0]) AS dy, unnest([0, 0, -1, 1]) AS dx)"
CELLS = "c AS (SELECT CAST(y AS BIGINT) * nx + x AS cell, y, x, code, nx, ny FROM raster)"
LINKS = """links AS (SELECT a.cell AS a, b.cell AS b FROM c a, off JOIN c b ON b.y = a.y + dy AND b.x = (a.x + dx + a.nx) % a.nx AND b.code = a.code)"""
REACH = """reach AS (SELECT cell, cell AS root FROM c UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.cell WHERE r.root < l.b),
lab AS (SELECT cell, min(root) AS region FROM reach GROUP BY cell)"""


@query(
    "gr1_label_regions",
    f"WITH RECURSIVE {RASTER}, {CELLS}, {OFF4}, {LINKS}, {REACH} SELECT y, x, code, region FROM c JOIN lab USING (cell)",
)
def label_regions(spark, sf):
    g = grid(spark, sf)
    return rg.label_regions(raster(spark, sf, g).select("y", "x", "code"), g.nx).select("y", "x", "code", "region")


@query(
    "gr1_label_regions_corners",
    f"WITH RECURSIVE {RASTER}, {CELLS}, {OFF8}, {LINKS}, {REACH} SELECT y, x, code, region FROM c JOIN lab USING (cell)",
)
def label_regions_corners(spark, sf):
    g = grid(spark, sf)
    return rg.label_regions(raster(spark, sf, g).select("y", "x", "code"), g.nx, extended=True).select("y", "x", "code", "region")


SEEDED = f"""{RASTER}, {CELLS}, {OFF4}, seed AS (SELECT cell, code FROM c WHERE y = 6 AND x = 0),
fill AS (SELECT cell, y, x, nx FROM c WHERE y = 6 AND x = 0 UNION SELECT n.cell, n.y, n.x, n.nx FROM fill f, off JOIN c n
  ON n.y = f.y + dy AND n.x = (f.x + dx + f.nx) % f.nx AND n.code = (SELECT code FROM seed))"""


@query(
    "gr1_floodfill",
    f"WITH RECURSIVE {SEEDED} SELECT y, x, CASE WHEN cell IN (SELECT cell FROM fill) THEN 42 ELSE code END AS code FROM c",
)
def floodfill(spark, sf):
    g = grid(spark, sf)
    return rg.floodfill(raster(spark, sf, g).select("y", "x", "code"), (6, 0), 42, g.nx, wrap=True)


@query("gr2_similar_region", f"WITH RECURSIVE {SEEDED} SELECT y, x FROM fill")
def similar_region(spark, sf):
    g = grid(spark, sf)
    return rg.find_similar(raster(spark, sf, g).select("y", "x", "code"), (6, 0), g.nx, wrap=True)


ICE = "CASE WHEN (y // 7 + 2 * (x // 7)) % 4 = 0 AND NOT (priority = '1-URGENT' AND status = 'F') THEN 1.0 ELSE 0.0 END"


@query(
    "gr3_keep_glacial_ice",
    f"""WITH RECURSIVE {RASTER}, i AS (SELECT y, x, nx, {ICE}::DOUBLE AS ice, CAST(y AS BIGINT) * nx + x AS cell FROM raster),
core AS (SELECT a.cell FROM i a JOIN i b ON b.y BETWEEN a.y - 2 AND a.y + 2 AND (b.x - a.x + 2 + a.nx) % a.nx <= 4 GROUP BY a.cell HAVING count_if(b.ice = 1) = count(*)),
c AS (SELECT * FROM i WHERE ice = 1), {OFF8},
links AS (SELECT a.cell AS a, b.cell AS b FROM c a, off JOIN c b ON b.y = a.y + dy AND b.x = (a.x + dx + a.nx) % a.nx), {REACH},
kept AS (SELECT DISTINCT region FROM lab JOIN core USING (cell)),
lost AS (SELECT cell FROM lab WHERE region NOT IN (SELECT region FROM kept))
SELECT y, x, pl, CASE WHEN cell IN (SELECT cell FROM lost) THEN CASE WHEN pl = 8 THEN 1.0 ELSE 0.0 END WHEN pl = 9 THEN ice ELSE 0.25 END::DOUBLE AS value
FROM i, (SELECT unnest([8, 9])::INT AS pl)""",
)
def keep_glacial_ice(spark, sf):
    g = grid(spark, sf)
    ice = raster(spark, sf, g).select("y", "x", F.expr(ICE.replace("//", "DIV")).cast("double").alias("value"))
    f = ice.withColumn("pl", F.lit(9)).unionByName(ice.withColumn("pl", F.lit(8)).withColumn("value", F.lit(0.25)))
    dense = materialise(complete(f, g.ny, g.nx, ["pl"]))
    return rg.keep_glacial_ice(dense, g.nx).join(ice.select("y", "x"), ["y", "x"], "left_semi").select("y", "x", "pl", "value")


@query(
    "gr4_fill_lakes",
    f"""WITH RECURSIVE {RASTER}, {AXES}, lakes AS (SELECT c_custkey AS lake, (c_acctbal - 4500) / 62 AS lat, CAST(c_custkey % 350 - 175 AS DOUBLE) + 0.3 AS lon FROM customer),
ys AS (SELECT lake, idx AS y, arg_min(idx, (round(abs(point - lat), 9), idx)) OVER (PARTITION BY lake) AS sy, count(*) OVER (PARTITION BY lake) AS n FROM lakes, ay, dims WHERE hi > lat - 540.0::DOUBLE / ny AND lo < lat + 540.0::DOUBLE / ny),
xs AS (SELECT lake, idx AS x, arg_min(idx, (round(abs(point - lon), 9), idx)) OVER (PARTITION BY lake) AS sx, count(*) OVER (PARTITION BY lake) AS n FROM lakes, ax, dims WHERE hi > lon - 1080.0::DOUBLE / nx AND lo < lon + 1080.0::DOUBLE / nx),
part AS (SELECT lake, r.y, r.x, code, sy, sx FROM raster r JOIN ys USING (y) JOIN xs USING (lake, x) WHERE ys.n > 1 AND xs.n > 1 AND code IN (1, 2)), {OFF4},
fill AS (SELECT lake, y, x, code FROM part WHERE y = sy AND x = sx UNION
  SELECT p.lake, p.y, p.x, p.code FROM fill f, off JOIN part p ON p.lake = f.lake AND p.y = f.y + dy AND p.x = f.x + dx AND p.code = f.code)
SELECT y, x, CASE WHEN (y, x) IN (SELECT (y, x) FROM fill) THEN 9 ELSE code END AS code FROM raster""",
)
def fill_lakes(spark, sf):
    g = grid(spark, sf)
    return rg.fill_lakes(raster(spark, sf, g).select("y", "x", "code"), lakes(spark, sf, g), *axes(spark, g), g.nx, [1, 2], 9)


def lakes(spark, sf, g):
    """One lake per customer with a box three cells wide to each side."""
    lat, lon = (F.col("c_acctbal") - 4500) / 62, (F.col("c_custkey") % 350 - 175).cast("double") + 0.3
    dy, dx = 540.0 / g.ny, 1080.0 / g.nx
    return read(spark, sf, "customer").select(
        F.col("c_custkey").alias("lake"), lat.alias("lat"), lon.alias("lon"), (lat - dy).alias("lat_min"), (lat + dy).alias("lat_max"),
        (lon - dx).alias("lon_min"), (lon + dx).alias("lon_max"),
    )


RUNOFF = f"""{RASTER}, {OFF8}, n AS MATERIALIZED (SELECT CAST(y AS BIGINT) * nx + x AS cell, y, x, price / 1e6 AS r, nx, ny FROM raster
  WHERE land = 0 AND y BETWEEN 1 AND ny - 2 AND x BETWEEN 1 AND nx - 2 AND price / 1e6 >= 1e-5),
links AS MATERIALIZED (SELECT a.cell AS a, b.cell AS b FROM n a, off JOIN n b ON b.y = a.y + dy AND b.x = a.x + dx AND b.r <= 1.1::DOUBLE * a.r),
reach(cell, low, root) USING KEY (cell) AS (SELECT cell, -r, cell FROM n UNION
  SELECT o.b, o.m.low, o.m.root FROM (SELECT l.b, min(struct_pack(low := w.low, root := w.root)) AS m FROM reach w JOIN links l ON l.a = w.cell GROUP BY l.b) o
  JOIN recurring.reach k ON k.cell = o.b WHERE o.m.low < k.low OR o.m.low = k.low AND o.m.root < k.root),
lab AS MATERIALIZED (SELECT cell, root FROM reach),
tot AS (SELECT lab.root, sum(n.r) AS total, count(*) AS cells, max(n.r) FILTER (n.cell = lab.root) AS top FROM lab JOIN n USING (cell) GROUP BY lab.root),
num AS (SELECT root, CAST(row_number() OVER (ORDER BY round(total, 9) DESC, top DESC, root) AS INT) AS river FROM tot)"""


def runoff(spark, sf, g):
    r = raster(spark, sf, g)
    flow = r.select("y", "x", (F.col("price") / 1e6).alias("r"))
    return rv.valid_runoff(flow, g.ny, g.nx, r.select("y", "x", (1 - F.col("land")).alias("sea")))


@query("gr5_number_rivers", f"WITH RECURSIVE {RUNOFF} SELECT y, x, r, lab.root, river FROM n JOIN lab USING (cell) JOIN num USING (root)")
def number_rivers(spark, sf):
    g = grid(spark, sf)
    out = rv.number_rivers(rv.runoff_regions(runoff(spark, sf, g), g.ny, g.nx))
    return out.select("y", "x", "r", "root", "river")


@query("ag8_region_totals", f"WITH RECURSIVE {RUNOFF} SELECT root, round(total, 8) AS total, cells, top FROM tot")
def region_totals(spark, sf):
    g = grid(spark, sf)
    return rv.region_totals(rv.runoff_regions(runoff(spark, sf, g), g.ny, g.nx)).withColumn("total", F.round("total", 8))


@query(
    "so3_rank_rivers",
    """SELECT o_custkey AS river, round(sum(o_totalprice), 2) AS total, row_number() OVER (ORDER BY round(sum(o_totalprice), 2) DESC, o_custkey) AS new_river FROM orders GROUP BY o_custkey""",
)
def rank_rivers(spark, sf):
    t = read(spark, sf, "orders").groupBy(F.col("o_custkey").alias("river")).agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    return rv.resort(t)


@query("so4_largest_cell", f"WITH {RASTER} SELECT y, x, value FROM raster WHERE value IS NOT NULL ORDER BY value DESC, y, x LIMIT 1")
def largest_cell(spark, sf):
    return rv.largest_cell(raster(spark, sf).select("y", "x", "value"))


@query("ag6_time_mean", """SELECT CAST(l_partkey % 36 AS INT) AS y, CAST(l_orderkey % 72 AS INT) AS x, round(avg(l_quantity), 6) AS r FROM lineitem GROUP BY ALL""")
def time_mean(spark, sf):
    li = read(spark, sf, "lineitem")
    return li.groupBy(F.expr("CAST(l_partkey % 36 AS INT)").alias("y"), F.expr("CAST(l_orderkey % 72 AS INT)").alias("x")).agg(F.round(F.avg("l_quantity"), 6).alias("r"))


@query(
    "ag7_grid_scaling",
    f"""WITH {RASTER}, p AS (SELECT x, (x * 360.0::DOUBLE / nx + y * 3) % 360 AS lon FROM raster WHERE y = ny // 2 AND x <= nx - 2)
SELECT round(0.25 / avg(d), 8) AS scaling FROM (SELECT lead(lon) OVER (ORDER BY x) - lon AS d FROM p) WHERE abs(d) <= 300""",
)
def grid_scaling(spark, sf):
    g = grid(spark, sf)
    lon = raster(spark, sf, g).select("y", "x", ((F.col("x") * 360.0 / g.nx + F.col("y") * 3) % 360).alias("lon"))
    return rv.grid_scaling(lon, g.ny, g.nx).select(F.round("scaling", 8).alias("scaling"))


@query(
    "jn21_nearest_ocean_point",
    f"""WITH {RASTER}, {AXES}, o AS (SELECT CAST(y AS BIGINT) * nx + x AS point, ax.point / 1000.0::DOUBLE AS px, ay.point / 1000.0::DOUBLE AS py FROM raster JOIN ax ON ax.idx = x JOIN ay ON ay.idx = y WHERE land = 0),
m AS (SELECT c_custkey AS id, (CASE WHEN l > 180 THEN l - 360 ELSE l END) / 1000.0::DOUBLE AS px, c_acctbal / 120 / 1000.0::DOUBLE AS py FROM (SELECT *, (c_custkey * 17 % 3600) / 10.0::DOUBLE AS l FROM customer))
SELECT id, arg_min(point, (round(sqrt((m.px - o.px) * (m.px - o.px) + (m.py - o.py) * (m.py - o.py)), 9), point)) AS point FROM m, o GROUP BY id""",
)
def nearest_ocean_point(spark, sf):
    g = grid(spark, sf)
    return rv.nearest_ocean_point(mouths(spark, sf), ocean(spark, sf, g).filter("sea = 1").select("point", "nav_lat", "nav_lon")).select("id", "point")


def mouths(spark, sf):
    return read(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), (F.col("c_acctbal") / 120).alias("lat"), ((F.col("c_custkey") * 17 % 3600) / 10.0).alias("lon"),
        (F.col("c_custkey") % 40).alias("sequence"),
    )


def ocean(spark, sf, g):
    ay, axx = axes(spark, g)
    r = raster(spark, sf, g).select("y", "x", (1 - F.col("land")).alias("sea"))
    r = r.join(ay.select(F.col("idx").alias("y"), F.col("point").alias("nav_lat")), "y").join(axx.select(F.col("idx").alias("x"), F.col("point").alias("nav_lon")), "x")
    return r.withColumn("point", F.col("y").cast("long") * g.nx + F.col("x"))


OUTS = "outs AS (SELECT y, x, CAST(cust + 1 AS INT) AS river, nx, ny FROM raster WHERE code = 6 AND status = 'F')"
SHORE = f"""{OFF8}, shore AS (SELECT DISTINCT c.y, c.x FROM raster c, off JOIN raster n ON n.y = least(greatest(c.y + dy, 0), c.ny - 1) AND n.x = (c.x + dx + c.nx) % c.nx WHERE c.land = 1 AND n.land = 0)"""


@query(
    "jn22_diamond_search",
    f"""WITH {RASTER}, {OUTS}, {SHORE}, s AS (SELECT c_custkey AS id, CAST(c_custkey * 5 % ny AS INT) AS sy, CAST(c_custkey * 7 % nx AS INT) AS sx, 1 + c_custkey % 6 AS md, nx, ny FROM customer, dims),
cand AS (SELECT y, x, river FROM outs UNION ALL SELECT y, x, NULL FROM shore),
d AS (SELECT id, md, river, CASE WHEN y = sy AND x = sx THEN CASE WHEN sy IN (0, ny - 1) THEN 1 ELSE nx END ELSE abs(y - sy) + least(abs(x - sx), nx - abs(x - sx)) END AS d FROM s, cand),
r AS (SELECT *, greatest(min(d) OVER (PARTITION BY id), md) AS radius FROM d)
SELECT id, min(river) AS river, CAST(max(radius) AS INT) AS radius FROM r WHERE d <= radius GROUP BY id""",
)
def diamond_search(spark, sf):
    g = grid(spark, sf)
    r = raster(spark, sf, g)
    outs = r.filter("code = 6 AND status = 'F'").select("y", "x", (F.col("cust") + 1).cast("int").alias("river"))
    shore = rv.coastal(r.select("y", "x", (1 - F.col("land")).alias("sea")), g.ny, g.nx)
    s = starts(spark, sf, g)
    return rv.diamond_search(s, outs, shore, g.ny, g.nx).select("id", "river", "radius")


def starts(spark, sf, g):
    k = F.col("c_custkey")
    return read(spark, sf, "customer").select(
        k.alias("id"), (k * 5 % g.ny).cast("int").alias("sy"), (k * 7 % g.nx).cast("int").alias("sx"), (1 + k % 6).cast("int").alias("min_distance")
    )


@query(
    "gr6_coastal_walk",
    f"""WITH RECURSIVE {RASTER}, {OFF8}, s AS (SELECT c_custkey AS id, CAST(c_custkey * 5 % ny AS INT) AS y, CAST(c_custkey * 7 % nx AS INT) AS x FROM customer, dims),
w AS (SELECT id, y, x, 1 AS land, 0 AS step FROM s UNION SELECT w.id, n.y, n.x, n.land, w.step + 1 FROM w, dims, off
  JOIN raster n ON n.y = least(greatest(w.y + dy, 0), dims.ny - 1) AND n.x = (w.x + dx + dims.nx) % dims.nx WHERE w.land = 1 AND w.step < 3)
SELECT DISTINCT id, y, x FROM w WHERE land = 0 AND step > 0""",
)
def coastal_walk(spark, sf):
    g = grid(spark, sf)
    s = starts(spark, sf, g).select("id", F.col("sy").alias("y"), F.col("sx").alias("x"))
    return rv.coastal_walk(s, raster(spark, sf, g).select("y", "x", (1 - F.col("land")).alias("sea")), g.ny, g.nx, 3)


GAPS = """o AS (SELECT o_orderkey AS cell, CAST(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_custkey + 1 END AS INT) AS river FROM orders),
l AS (SELECT c_custkey AS id, CAST(c_custkey * 3 % 2000 AS INT) AS river FROM customer),
gone AS (SELECT DISTINCT river AS g FROM o WHERE river > 0 AND river NOT IN (SELECT river FROM l))"""


def gap_tables(spark, sf):
    o = read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("cell"), F.when(F.col("o_orderstatus") == "P", 0).otherwise(F.col("o_custkey") + 1).cast("int").alias("river")
    )
    return o, read(spark, sf, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_custkey") * 3 % 2000).cast("int").alias("river"))


@query("gr8_close_gaps_ocean", f"WITH {GAPS} SELECT cell, CASE WHEN river IN (SELECT g FROM gone) THEN 0 ELSE river - (SELECT count(*) FROM gone WHERE g < river) END::INT AS river FROM o")
def close_gaps_ocean(spark, sf):
    return rv.close_gaps(*gap_tables(spark, sf))[0]


@query("gr8_close_gaps_land", f"WITH {GAPS} SELECT id, CAST(river - (SELECT count(*) FROM gone WHERE g < river) AS INT) AS river FROM l")
def close_gaps_land(spark, sf):
    return rv.close_gaps(*gap_tables(spark, sf))[1]


@query("sk13_ocean_river_table", f"WITH RECURSIVE {RUNOFF} SELECT q.y, q.x, coalesce(river, 0)::INT AS river FROM raster q LEFT JOIN (SELECT y, x, river FROM n JOIN lab USING (cell) JOIN num USING (root)) k ON k.y = q.y AND k.x = q.x")
def ocean_table(spark, sf):
    g = grid(spark, sf)
    num = rv.number_rivers(rv.runoff_regions(runoff(spark, sf, g), g.ny, g.nx))
    return ocean_river_table(num, raster(spark, sf, g).select("y", "x"))


@query("gr9_link_mouths")
def link_mouths(spark, sf):
    g = grid(spark, sf)
    o = ocean(spark, sf, g)
    num = rv.number_rivers(rv.runoff_regions(runoff(spark, sf, g), g.ny, g.nx))
    return rv.link_mouths(mouths(spark, sf), o, o.select("y", "x", "sea"), materialise(num.select("y", "x", "river")), 0.15, g.ny, g.nx)[0]


@query(
    "fn10_neighbour_step",
    f"""WITH {RASTER}, d AS (SELECT y, x, 1 + cust % 9 AS dir, nx, ny FROM raster)
SELECT y, x, dir, CASE WHEN dir < 9 THEN CAST(least(greatest(y + CASE WHEN dir IN (1, 2, 8) THEN 1 WHEN dir IN (4, 5, 6) THEN -1 ELSE 0 END, 0), ny - 1) AS INT) END AS to_y,
  CASE WHEN dir < 9 THEN CAST((x + CASE WHEN dir IN (2, 3, 4) THEN 1 WHEN dir IN (6, 7, 8) THEN -1 ELSE 0 END + nx) % nx AS INT) END AS to_x FROM d""",
)
def neighbour_step(spark, sf):
    g = grid(spark, sf)
    return rv.shift(raster(spark, sf, g).select("y", "x", (1 + F.col("cust") % 9).alias("dir")), "dir", g.ny, g.nx)
