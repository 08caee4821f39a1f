"""Class crosswalks, fractions, ice and ocean rules, masks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridloom.functions.columns import nan
from gridloom.operators import classes as cl
from gridloom.operators.regrid import nearest
from gridloom.sources import fields as fl
from gridloom.sources.crosswalk import from_arrays
from workload.fixtures import AXES, RASTER, TILES, axes, grid, raster, read, tiles
from workload.registry import query
from workload.regridding import HALF, ODD, coarse_axes, odd_axes, overlap_sql

#: Shares of part kinds per brand: each brand is a source class, the part's size class a target class.
SHARES = """shares AS (SELECT l_suppkey AS map, lower('type' || l_partkey % 7) AS source_type, CAST(l_linenumber AS INT) AS target_type,
  sum(l_quantity) / sum(sum(l_quantity)) OVER (PARTITION BY l_suppkey, l_partkey % 7) AS share FROM lineitem GROUP BY l_suppkey, l_partkey % 7, l_linenumber)"""


def shares(spark, sf):
    li = read(spark, sf, "lineitem").groupBy(
        F.col("l_suppkey").alias("map"), F.concat(F.lit("type"), (F.col("l_partkey") % 7).cast("string")).alias("source_type"),
        F.col("l_linenumber").alias("target_type"),
    ).agg(F.sum("l_quantity").alias("q"))
    w = Window.partitionBy("map", "source_type")
    return li.select("map", "source_type", "target_type", (F.col("q") / F.sum("q").over(w)).alias("share"))


@query(
    "sc6_crosswalk_percentages",
    f"""WITH {SHARES}, r AS (SELECT *, CAST(round_even(share * 100, 0) AS INT) AS p FROM shares),
k AS (SELECT *, 100 - sum(p) OVER (PARTITION BY map, source_type) AS lack, row_number() OVER (PARTITION BY map, source_type ORDER BY p DESC, target_type) AS rn FROM r)
SELECT map, source_type, target_type, CAST(CASE WHEN rn = 1 THEN p + lack ELSE p END AS INT) AS pct FROM k""",
)
def crosswalk_percentages(spark, sf):
    return cl.crosswalk_percentages(shares(spark, sf), ["map"]).drop("total")


@query(
    "sc6_crosswalk_arrays",
    """SELECT p_partkey AS map, lower(s) AS source_type, CAST(j AS INT) AS target_type, CASE WHEN (i + j + p_size) % 3 = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS share
FROM (SELECT p_partkey, p_size, unnest(['A', 'B']) AS s, unnest([0, 1]) AS i FROM part), (SELECT unnest([0, 1, 2]) AS j)""",
)
def crosswalk_arrays(spark, sf):
    one = lambda i: F.array(*[F.when((F.lit(i + j) + F.col("p_size")) % 3 == 0, 1.0).otherwise(0.0) for j in range(3)])
    p = read(spark, sf, "part").select(
        F.col("p_partkey").alias("map"), F.array(F.lit("A"), F.lit("B")).alias("source"),
        F.array(F.lit(0), F.lit(1), F.lit(2)).alias("target"), F.array(one(0), one(1)).alias("cover_map"),
    )
    return from_arrays(p, ["map"])


#: Crosswalk from the codes 0..6 of the raster to classes 0..9: codes 1 and 4 go wholly to class 8, the others are split.
WALK = [(c, t, p) for c, row in {
    0: {0: 100}, 1: {8: 100}, 2: {1: 60, 2: 40}, 3: {3: 50, 4: 30, 8: 20}, 4: {8: 100}, 5: {0: 25, 5: 75}, 6: {9: 100},
}.items() for t in range(10) for p in [row.get(t, 0)]]
WALK_SQL = "walk AS (SELECT * FROM (VALUES " + ", ".join(str(w) for w in WALK) + ") t(code, target_type, pct))"


def walk(spark):
    return spark.createDataFrame(WALK, "code INT, target_type INT, pct INT")


@query(
    "jn13_apply_crosswalk",
    f"WITH {RASTER}, {WALK_SQL} SELECT y, x, target_type AS pl, CASE WHEN value IS NOT NULL THEN pct END::DOUBLE AS value FROM raster, (SELECT DISTINCT target_type FROM walk) LEFT JOIN (SELECT code AS c, target_type AS tt, pct FROM walk) ON c = code AND tt = target_type",
)
def apply_crosswalk(spark, sf):
    r = raster(spark, sf).select("y", "x", F.when(F.col("value").isNotNull(), F.col("code")).alias("code"))
    return cl.apply_crosswalk(r, walk(spark))


@query(
    "jn14_match_flags",
    f"""WITH {SHARES}, one AS (SELECT source_type, target_type, sum(share) AS share FROM shares GROUP BY ALL), s AS (SELECT *, share / sum(share) OVER (PARTITION BY source_type) AS f FROM one),
r AS (SELECT *, CAST(round_even(f * 100, 0) AS INT) AS p FROM s), k AS (SELECT *, 100 - sum(p) OVER (PARTITION BY source_type) AS lack, row_number() OVER (PARTITION BY source_type ORDER BY p DESC, target_type) AS rn FROM r)
SELECT CAST(right(source_type, 1) AS INT) + 10 AS code, target_type, CAST(CASE WHEN rn = 1 THEN p + lack ELSE p END AS INT) AS pct FROM k""",
)
def match_flags(spark, sf):
    """The whole percentages of one crosswalk, its type names in capitals, matched with the flags of a field."""
    one = shares(spark, sf).groupBy("source_type", "target_type").agg(F.sum("share").alias("share"))
    one = one.withColumn("share", F.col("share") / F.sum("share").over(Window.partitionBy("source_type")))
    s = cl.crosswalk_percentages(one).select(F.upper("source_type").alias("source_type"), "target_type", "pct")
    flags = spark.createDataFrame([(10 + i, f"Type{i}") for i in range(7)], "flag_value INT, flag_meaning STRING")
    return cl.match_flags(s, flags)


@query(
    "ag11_fold_classes",
    f"WITH {RASTER} SELECT y, x, CASE WHEN code = 4 THEN 1 ELSE code END AS code FROM raster",
)
def fold_classes(spark, sf):
    return cl.recode(raster(spark, sf).select("y", "x", "code"), cl.fold_whole_classes(walk(spark)))


NORM = "CASE WHEN sum(c) OVER (PARTITION BY y, x) = 0 THEN c ELSE c / sum(c) OVER (PARTITION BY y, x) END"


@query(
    "ag3_normalise_fractions",
    f"""WITH {RASTER}, {TILES}, c AS (SELECT y, x, pl, CASE WHEN pl = 7 THEN NULL ELSE least(greatest(value - 0.003::DOUBLE, 0), 1) END AS c FROM tiles)
SELECT y, x, pl, round({NORM}, 9) AS value FROM c""",
)
def normalise_fractions(spark, sf):
    f = tiles(spark, sf).withColumn("value", F.when(F.col("pl") != 7, F.col("value") - 0.003))
    return cl.normalise(f).withColumn("value", F.round("value", 9))


@query("pf5_class_levels", f"WITH {RASTER}, {TILES} SELECT y, x, pl, round(value, 9) AS value FROM tiles WHERE pl IN (3, 9)")
def class_levels(spark, sf):
    return cl.class_levels(tiles(spark, sf), [3, 9]).withColumn("value", F.round("value", 9))


@query("pf18_land_fraction", f"WITH {RASTER}, {TILES} SELECT y, x, round(1 - value, 9) AS value FROM tiles WHERE pl = 0")
def land_fraction(spark, sf):
    return cl.land_fraction(tiles(spark, sf)).withColumn("value", F.round("value", 9))


FRACTIONS = f"""{RASTER}, {TILES}, fr AS (SELECT y, x, pl, value / sum(value) OVER (PARTITION BY y, x) AS value FROM tiles)"""


def fractions(spark, sf):
    return cl.normalise(tiles(spark, sf))


ICE_SQL = f"""{FRACTIONS}, i AS (SELECT *, max(value) FILTER (pl = 9) OVER (PARTITION BY y, x) AS ice FROM fr),
c AS (SELECT y, x, pl, CASE WHEN ice >= 0.5 THEN CASE WHEN pl = 9 THEN 1.0 ELSE 0 END WHEN pl = 9 THEN 0 ELSE value END AS c FROM i),
ice AS (SELECT y, x, pl, {NORM} AS value FROM c)"""


@query("lc1_whole_fraction_ice", f"WITH {ICE_SQL} SELECT y, x, pl, round(value, 9) AS value FROM ice")
def whole_fraction_ice(spark, sf):
    return cl.whole_fraction_ice(fractions(spark, sf)).withColumn("value", F.round("value", 9))


OCEAN_SQL = f"""{FRACTIONS}, o AS (SELECT *, max(value) FILTER (pl = 0) OVER (PARTITION BY y, x) AS sea FROM fr),
c AS (SELECT y, x, pl, sea, CASE WHEN sea < 0.5 AND pl = 0 THEN 0 ELSE value END AS c FROM o),
dry AS (SELECT y, x, pl, CASE WHEN coalesce(sea, 0) < 0.5 THEN v END AS value FROM (SELECT *, {NORM} AS v FROM c) WHERE pl > 0)"""


@query("lc2_remove_ocean", f"WITH {OCEAN_SQL} SELECT y, x, pl, round(value, 9) AS value FROM dry")
def remove_ocean(spark, sf):
    return cl.remove_ocean(fractions(spark, sf)).withColumn("value", F.round("value", 9))


@query("lc2_land_mask", f"WITH {OCEAN_SQL} SELECT y, x, CASE WHEN count(value) > 0 THEN 1 ELSE 0 END AS land FROM dry GROUP BY y, x")
def land_mask(spark, sf):
    return cl.land_mask(cl.remove_ocean(fractions(spark, sf)))


LC3 = f"""{RASTER}, {AXES}, {HALF}, {WALK_SQL}, {overlap_sql('wx', 'ax', 'hx', False)}, {overlap_sql('wy', 'ay', 'hy', True)},
c AS (SELECT wy.t AS y, wx.t AS x, target_type AS pl, sum(pct * wx.w * wy.w) / sum(wx.w * wy.w) / 100 AS c
  FROM raster r JOIN wx ON wx.s = r.x JOIN wy ON wy.s = r.y JOIN walk USING (code) GROUP BY ALL)"""


@query("lc3_class_transform", f"WITH {LC3} SELECT y, x, pl, round({NORM}, 9) AS value FROM c")
def class_transform(spark, sf):
    g = grid(spark, sf)
    out = cl.transform_classes(raster(spark, sf, g), walk(spark), (*axes(spark, g), *coarse_axes(spark, g)))
    return out.withColumn("value", F.round("value", 9))


@query("lc3_whole_classes", f"WITH {RASTER} SELECT y, x, pl, CAST(pl = code + 1 AS TINYINT) AS value FROM raster, (SELECT unnest(range(1, 8))::INT AS pl)")
def whole_classes(spark, sf):
    table = spark.createDataFrame([(c, t, 100 if t == c + 1 else 0) for c in range(7) for t in range(1, 8)], "code INT, target_type INT, pct INT")
    return cl.transform_classes(raster(spark, sf), table)


@query(
    "jn23_split_grass",
    f"""WITH {FRACTIONS}, p AS (SELECT y, x, price / 5000 / 100 AS c4 FROM raster),
g AS (SELECT f.*, least(c4, max(f.value) FILTER (pl = 3) OVER (PARTITION BY f.y, f.x)) AS moved FROM fr f JOIN p ON p.y = f.y AND p.x = f.x WHERE pl <> 4)
SELECT y, x, pl, round(CASE WHEN pl = 3 THEN value - moved ELSE value END, 8) AS value FROM g""",
)
def split_grass(spark, sf):
    f = fractions(spark, sf).filter("pl <> 4")
    c4 = raster(spark, sf).select("y", "x", (F.col("price") / 5000).alias("value"))
    return cl.split_grass(f, c4).withColumn("value", F.round("value", 8))


@query(
    "jn23_injected_class",
    f"""WITH {FRACTIONS}, p AS (SELECT y, x, price / 5000 / 100 AS c4 FROM raster), c3 AS (SELECT y, x, value FROM fr WHERE pl = 3)
SELECT c3.y, c3.x, round(least(c4, value), 8) AS value FROM c3 JOIN p ON p.y = c3.y AND p.x = c3.x""",
)
def injected_class(spark, sf):
    f = fractions(spark, sf).filter("pl = 3")
    f = f.unionByName(f.withColumn("pl", F.lit(4)).withColumn("value", F.lit(0.0)))
    c4 = raster(spark, sf).select("y", "x", (F.col("price") / 5000).alias("value"))
    return cl.split_grass(f, c4).filter("pl = 4").select("y", "x", F.round("value", 8).alias("value"))


@query("pf11_masks_from_fraction", f"WITH {RASTER}, f AS (SELECT y, x, CASE status WHEN 'F' THEN 0.0 WHEN 'O' THEN 1.0 ELSE price / 1e6 END AS value FROM raster) SELECT y, x, CASE WHEN value > 0 THEN 1 ELSE 0 END AS land_mask, CASE WHEN value < 1 THEN 0 ELSE 1 END AS sea_mask FROM f")
def masks_from_fraction(spark, sf):
    f = raster(spark, sf).withColumn("value", F.when(F.col("status") == "F", 0.0).when(F.col("status") == "O", 1.0).otherwise(F.col("price") / 1e6))
    return cl.masks_from_fraction(f.select("y", "x", "value")).drop("value")


@query(
    "pf14_nan_edge_rows",
    f"""WITH {RASTER}, f AS (SELECT y, x, ny, CASE WHEN code = 6 THEN CAST('NaN' AS DOUBLE) ELSE value END AS v FROM raster)
SELECT y, x, CASE WHEN isnan(v) AND y = 0 THEN 0.0 WHEN isnan(v) AND y = ny - 1 THEN 1.0 ELSE v END AS value FROM f""",
)
def nan_edge_rows(spark, sf):
    from gridloom.plans.jobs import fix_edge_rows

    g = grid(spark, sf)
    r = raster(spark, sf, g).select("y", "x", F.when(F.col("code") == 6, nan()).otherwise(F.col("value")).alias("value"))
    return fix_edge_rows(r, g.ny)


@query("pf12_mask_value", f"WITH {RASTER} SELECT y, x, nullif(value, 100) AS value FROM raster")
def mask_value(spark, sf):
    return raster(spark, sf).select("y", "x", F.nullif("value", F.lit(100.0)).alias("value"))


@query("st5_recode_by_other", f"WITH {RASTER} SELECT r.y, r.x, CASE WHEN o.code = 5 THEN 0 ELSE r.code END AS code FROM raster r LEFT JOIN raster o ON o.y = r.y + 3 AND o.x = r.x + 1")
def recode_by_other(spark, sf):
    r = raster(spark, sf).select("y", "x", "code")
    other = r.select((F.col("y") - 3).alias("y"), (F.col("x") - 1).alias("x"), "code")
    return cl.recode_where(r, other, F.col("_other") == 5, 0)


@query(
    "st6_add_lakes",
    f"""WITH {RASTER}, {AXES}, {ODD},
wx AS (SELECT o.idx AS t, arg_max(a.idx, (-round(least(abs(a.point - o.point), 360 - abs(a.point - o.point)), 9), a.idx)) AS s FROM ox a, ax o GROUP BY ALL),
wy AS (SELECT o.idx AS t, arg_max(a.idx, (-round(abs(a.point - o.point), 9), a.idx)) AS s FROM oy a, ay o GROUP BY ALL),
c AS (SELECT i AS y, j AS x, (i * 3 + j) % 5 AS code FROM range(17) a(i), range(31) b(j))
SELECT r.y, r.x, CASE WHEN c.code = 2 THEN 0 ELSE r.land END AS land FROM raster r JOIN wx ON wx.t = r.x JOIN wy ON wy.t = r.y JOIN c ON c.y = wy.s AND c.x = wx.s""",
)
def add_lakes(spark, sf):
    g = grid(spark, sf)
    cls = spark.range(17 * 31).select(F.expr("CAST(id DIV 31 AS INT)").alias("y"), F.expr("CAST(id % 31 AS INT)").alias("x"))
    cls = cls.withColumn("code", (F.col("y") * 3 + F.col("x")) % 5)
    fine = nearest(cls, *odd_axes(spark), *axes(spark, g), period=360.0)
    return cl.recode_where(raster(spark, sf, g).select("y", "x", F.col("land").alias("code")), fine, F.col("_other") == 2, 0).withColumnRenamed("code", "land")


@query(
    "st4_polar_replacement",
    f"""WITH {RASTER}, s AS (SELECT y, x, -90 + (y + 0.5) * 180 / ny AS lat, CASE WHEN status = 'F' THEN 1.0 ELSE price / 1e6 END AS v, code FROM raster)
SELECT y, x, CASE WHEN lat < -60 THEN CASE WHEN v > 0.5 THEN -36 ELSE -45 END ELSE code END AS code FROM s""",
)
def polar_replacement(spark, sf):
    from gridloom.operators.merge import overwrite

    g = grid(spark, sf)
    r = raster(spark, sf, g)
    south = r.filter(F.lit(-90.0) + (F.col("y") + 0.5) * 180 / g.ny < -60)
    snow = south.select("y", "x", F.when(F.col("status") == "F", 1.0).otherwise(F.col("price") / 1e6).alias("value"))
    return overwrite(r.select("y", "x", "code"), cl.polar_replacement(snow), ["y", "x"], "code")


@query(
    "sc2_land_mask_by_name",
    f"WITH {RASTER} SELECT y, x, land <> 0 AS land FROM raster",
)
def mask_by_name(spark, sf):
    r = raster(spark, sf)
    f = r.select(F.lit("land_binary_mask").alias("name"), "y", "x", F.col("land").cast("double").alias("value"))
    return fl.land_mask(f.unionByName(r.select(F.lit("a").alias("name"), "y", "x", "value")))


@query("sc2_land_mask_by_fraction", f"WITH {RASTER}, {TILES} SELECT y, x, max(value) > 0.04 AS land FROM tiles GROUP BY y, x")
def mask_by_fraction(spark, sf):
    return fl.land_mask(tiles(spark, sf).withColumn("name", F.lit("vegetation_area_fraction")), 0.04)


@query("sc2_land_mask_by_missing", f"WITH {RASTER} SELECT y, x, value IS NOT NULL AS land FROM raster")
def mask_by_missing(spark, sf):
    r = raster(spark, sf)
    f = r.select(F.lit("b").alias("name"), "y", "x", F.lit(1.0).alias("value")).unionByName(r.select(F.lit("a").alias("name"), "y", "x", "value"))
    return fl.land_mask(f)


@query(
    "qa4_mask_problems",
    f"WITH {RASTER} SELECT count(*) AS cells, count_if(land IS NULL) AS masked, count_if(land NOT IN (0, 1)) AS other FROM (SELECT CASE WHEN code = 5 THEN NULL WHEN code = 4 THEN 7 ELSE land END AS land FROM raster)",
)
def mask_problems(spark, sf):
    from gridloom.operators.check import mask_problems as problems

    return problems(raster(spark, sf).withColumn("land", F.when(F.col("code") == 4, 7).when(F.col("code") != 5, F.col("land"))))
