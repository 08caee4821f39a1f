"""Time axes, records, gases, vertical levels, checks, filter, tiles."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridloom.operators import check as ck
from gridloom.operators import filters as ft
from gridloom.operators import gases as gs
from gridloom.operators import tiles as tl
from gridloom.operators import timeaxis as ta
from gridloom.operators.regrid import complete
from gridloom.operators import vertical as vt
from gridloom.sinks import writers as wr
from gridloom.sources import fields as fl
from gridloom.sources import mesh as ms
from workload.fixtures import (
    GASES, LEVELS, MONTH_AXES, MONTHLY, RASTER, RECORDS, axes, gases, grid, levels, month_axes, monthly, raster, read, records,
)
from workload.registry import query


def with_months(spark, sf):
    return monthly(spark, sf).withColumn("year", (1995 + F.floor(F.col("t") / 12)).cast("int")).withColumn("month", (F.col("t") % 12 + 1).cast("int"))


YM = f"{MONTHLY}, ym AS (SELECT *, CAST(1995 + t // 12 AS INT) AS year, CAST(t % 12 + 1 AS INT) AS month FROM monthly)"


@query("pf1_year_range", f"WITH {YM} SELECT field_id, t, y, x, value, year, month FROM ym WHERE year BETWEEN 1996 AND 1998")
def year_range(spark, sf):
    return ta.year_range(with_months(spark, sf), 1996, 1998)


TWELVE = "CASE WHEN field_id % 2 = 0 THEN month ELSE t END"


@query("sc15_climatologies", f"WITH {YM}, q AS (SELECT field_id, {TWELVE} AS k, y, x, value FROM ym) SELECT field_id, k, y, x, value FROM q WHERE field_id IN (SELECT field_id FROM q GROUP BY field_id HAVING count(DISTINCT k) = 12)")
def climatologies(spark, sf):
    q = with_months(spark, sf).select("field_id", F.expr(TWELVE).alias("k"), "y", "x", "value")
    return ta.split_climatologies(q, True, t="k")


@query("sc15_series", f"WITH {YM}, q AS (SELECT field_id, {TWELVE} AS k, y, x, value FROM ym) SELECT field_id, k, y, x, value FROM q WHERE field_id IN (SELECT field_id FROM q GROUP BY field_id HAVING count(DISTINCT k) <> 12)")
def not_climatologies(spark, sf):
    q = with_months(spark, sf).select("field_id", F.expr(TWELVE).alias("k"), "y", "x", "value")
    return ta.split_climatologies(q, False, t="k")


@query(
    "pf10_month_means",
    """SELECT o_orderkey, lo, hi, lo + to_hours(12 * CAST(date_diff('day', lo, hi) AS INT)) AS point FROM (
  SELECT o_orderkey, date_trunc('month', o_orderdate) AS lo, date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS hi FROM (SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS o_orderdate FROM orders))""",
)
def month_means(spark, sf):
    b = ta.month_bounds(F.year("o_orderdate"), F.month("o_orderdate"))
    return read(spark, sf, "orders").select("o_orderkey", b.alias("b")).select("o_orderkey", "b.lo", "b.hi", "b.point")


@query(
    "wn7_midpoints",
    """SELECT cust, t, round(coalesce((v + lead(v) OVER w) / 2, v + (v - lag(v) OVER w) / 2, v), 4) AS value FROM (
  SELECT o_custkey AS cust, o_orderkey AS t, o_totalprice AS v FROM orders) WINDOW w AS (PARTITION BY cust ORDER BY t)""",
)
def midpoints(spark, sf):
    s = read(spark, sf, "orders").select(F.col("o_custkey").alias("cust"), F.col("o_orderkey").alias("t"), F.col("o_totalprice").alias("value"))
    return ta.midpoints(s, ["cust"]).withColumn("value", F.round("value", 4))


@query(
    "wn7_year_starts",
    f"""WITH {GASES}, s AS (SELECT gas, sector, CAST(floor(1850 + days / 365) AS INT) AS year, value AS v FROM gases),
p AS (SELECT *, lag(v) OVER w AS u, lead(v) OVER w AS n FROM s WINDOW w AS (PARTITION BY gas, sector ORDER BY year))
SELECT gas, sector, year, round(coalesce((u + v) / 2, v), 4) AS value FROM p WHERE year BETWEEN 1995 AND 2002
UNION ALL SELECT gas, sector, year + 1, round(v + (v - u) / 2, 4) FROM p WHERE n IS NULL AND year + 1 <= 2002""",
)
def year_starts(spark, sf):
    s = gases(spark, sf).select("gas", "sector", F.floor(1850 + F.col("days") / 365).cast("int").alias("year"), "value")
    return ta.year_starts(s, ["gas", "sector"], 1995, 2002).withColumn("value", F.round("value", 4))


@query("sc17_last_years", f"WITH {GASES} SELECT gas, sector, days, value FROM (SELECT *, row_number() OVER (PARTITION BY gas, sector ORDER BY days DESC) AS rn FROM gases) WHERE rn <= 3")
def last_years(spark, sf):
    return ta.last_years(gases(spark, sf), ["gas", "sector"], 3, "days")


@query("sc16_global_sector", f"WITH {GASES} SELECT gas, days, round(value, 4) AS value FROM gases WHERE sector = 0")
def global_sector(spark, sf):
    return gases(spark, sf).filter("sector = 0").select("gas", "days", F.round("value", 4).alias("value"))


POINTS = """times AS (SELECT cust, CASE cust % 5 WHEN 0 THEN TIMESTAMP '2000-02-15' + to_years(CAST(k AS INT)) WHEN 1 THEN TIMESTAMP '2000-02-15' + to_months(CAST(k AS INT))
  WHEN 2 THEN TIMESTAMP '2000-02-15' + to_days(CAST(k * 5 AS INT)) WHEN 3 THEN TIMESTAMP '2000-02-15' + to_hours(CAST(k * 7 AS INT)) ELSE TIMESTAMP '2000-02-15' + to_days(CAST(k * k AS INT)) END AS point
  FROM (SELECT o_custkey AS cust, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders))"""


def time_points(spark, sf):
    k = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    o = read(spark, sf, "orders").select(F.col("o_custkey").alias("cust"), k.alias("k"))
    start = "timestamp_ntz'2000-02-15 00:00:00'"
    return o.select("cust", F.expr(
        f"CASE cust % 5 WHEN 0 THEN {start} + make_ym_interval(k, 0) WHEN 1 THEN {start} + make_ym_interval(0, k) WHEN 2 THEN {start} + make_dt_interval(k * 5)"
        f" WHEN 3 THEN {start} + make_dt_interval(0, k * 7) ELSE {start} + make_dt_interval(k * k) END").alias("point"))


INTERVAL_SQL = """d AS (SELECT cust, point, lead(point) OVER (PARTITION BY cust ORDER BY point) AS n FROM times),
i AS (SELECT cust, count(*) AS steps, min(m) AS m0, max(m) AS m1, min(s) AS s0, max(s) AS s1 FROM (
  SELECT cust, CASE WHEN day(n) = day(point) AND CAST(n AS TIME) = CAST(point AS TIME) THEN (year(n) - year(point)) * 12 + month(n) - month(point) ELSE -1 END AS m,
    CAST(epoch(n) - epoch(point) AS BIGINT) AS s FROM d WHERE n IS NOT NULL) GROUP BY cust),
iv AS (SELECT cust, steps, CASE WHEN m0 = 12 AND m1 = 12 THEN 'annual' WHEN m0 = 1 AND m1 = 1 THEN 'monthly'
  WHEN s0 = s1 AND s0 % 86400 = 0 THEN (s0 // 86400) || ' days' WHEN s0 = s1 AND s0 % 3600 = 0 THEN (s0 // 3600) || ' hours' END AS interval FROM i)"""


@query("wn8_time_interval", f"WITH {POINTS}, {INTERVAL_SQL} SELECT cust, steps, interval FROM iv")
def time_interval(spark, sf):
    return ta.interval(time_points(spark, sf), ["cust"])


BOUNDED = """b AS (SELECT cust, point, date_trunc('month', point) AS lo, date_trunc('month', point) + to_months(CASE WHEN cust % 2 = 0 THEN 12 ELSE 1 END) AS hi FROM times),
per AS (SELECT cust, min(lo) AS first, max(hi) AS last, count(*) AS n FROM b GROUP BY cust)"""
PERIODIC = "n > 1 AND year(last) = year(first) + 1 AND strftime(last, '%m-%d %H:%M') = strftime(first, '%m-%d %H:%M')"


def bounded_times(spark, sf):
    t = time_points(spark, sf)
    lo = F.trunc(F.col("point").cast("date"), "month")
    return t.select(
        "cust", "point", lo.cast("timestamp_ntz").alias("lo"),
        F.add_months(lo, F.when(F.col("cust") % 2 == 0, 12).otherwise(1)).cast("timestamp_ntz").alias("hi"),
    )


@query("wn9_periodic", f"WITH {POINTS}, {BOUNDED} SELECT cust, first, last, n, {PERIODIC} AS periodic FROM per")
def periodic(spark, sf):
    return ta.periodic(bounded_times(spark, sf), ["cust"])


@query(
    "sk5_time_header",
    f"""WITH {POINTS}, {BOUNDED}, {INTERVAL_SQL}, e AS (SELECT cust, min(point) AS t1, max(point) AS t2 FROM b GROUP BY cust)
SELECT e.cust, CASE WHEN {PERIODIC} THEN 2 WHEN n > 1 THEN 1 ELSE 0 END AS time_type, n, t1, t2, interval FROM e JOIN per USING (cust) LEFT JOIN iv USING (cust)""",
)
def time_header(spark, sf):
    return ta.time_header(bounded_times(spark, sf), ["cust"])


@query(
    "wn10_contiguous_bounds",
    """WITH r AS (SELECT o_custkey AS file, o_orderkey AS seq, CAST(o_orderdate AS TIMESTAMP) AS lo FROM orders),
t AS (SELECT file, lo, coalesce(lead(lo) OVER (PARTITION BY file ORDER BY lo), min(lo) OVER (PARTITION BY file) + INTERVAL 12 MONTH) AS hi FROM (SELECT DISTINCT file, lo FROM r))
SELECT r.file, seq, strftime(r.lo, '%Y-%m-%d') AS lo, strftime(t.hi, '%Y-%m-%d') AS hi FROM r JOIN t ON t.file = r.file AND t.lo = r.lo""",
)
def contiguous_bounds(spark, sf):
    r = read(spark, sf, "orders").select(F.col("o_custkey").alias("file"), F.col("o_orderkey").alias("seq"), F.col("o_orderdate").alias("lo"))
    out = ta.contiguous_bounds(r, ["file"])
    return out.select("file", "seq", *[F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("lo", "hi")])


@query("ag9_equal_counts", """SELECT file, count(*) AS times, min(n) = max(n) AS equal FROM (SELECT l_suppkey AS file, date_trunc('month', l_shipdate) AS m, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY file""")
def equal_counts(spark, sf):
    li = read(spark, sf, "lineitem").select(F.col("l_suppkey").alias("file"), F.trunc("l_shipdate", "month").alias("m"))
    return ta.equal_counts(li, ["file"], ["m"])


@query(
    "wn12_pad_ends",
    f"""WITH {YM}, p AS (SELECT field_id, year, month, y, x, value FROM ym WHERE year NOT IN (1995, 2000, 2001) UNION ALL SELECT field_id, 1995, month, y, x, value FROM ym WHERE year = 1996
  UNION ALL SELECT field_id, k, month, y, x, value FROM ym, (SELECT unnest([2000, 2001]) AS k) WHERE year = 1999)
SELECT field_id, CAST(year AS INT) AS year, month, y, x, value, CAST((dense_rank() OVER (PARTITION BY field_id ORDER BY year, month) - 1) * 30 + 15 AS INT) AS days FROM p""",
)
def pad_ends(spark, sf):
    m = with_months(spark, sf).drop("t")
    return ta.pad_ends(m, ["field_id"], 1995, 2001, 1996, 1999, repeat_last=2)


@query("pf9_climatology_year", f"""WITH {RECORDS} SELECT file, seq, stash, model, 2000 AS yr, mon, 1 AS dat, CASE WHEN mon = 12 THEN 2001 ELSE 2000 END AS yrd, CASE WHEN mon = 12 THEN 1 ELSE mon + 1 END AS mond, 1 AS datd, proc,
  20 + CASE WHEN max(greatest(dat, datd)) OVER (PARTITION BY file) > 30 THEN 1 ELSE 2 END AS tim FROM records""")
def climatology_year(spark, sf):
    return ta.climatology_records(records(spark, sf), 2000, ["file"])


@query("pf8_reference_year", f"WITH {RECORDS} SELECT * REPLACE (yr + o AS yr, yrd + o AS yrd) EXCLUDE (o) FROM (SELECT *, 4 - min(yr) OVER (PARTITION BY file) AS o FROM records)".replace("* REPLACE (yr + o AS yr, yrd + o AS yrd) EXCLUDE (o)", "* EXCLUDE (o) REPLACE (yr + o AS yr, yrd + o AS yrd)"))
def reference_year(spark, sf):
    return ta.shift_reference_year(records(spark, sf), ["file"])


@query("pf7_non_negative_proc", f"WITH {RECORDS} SELECT * REPLACE (greatest(proc, 0) AS proc) FROM records")
def non_negative_proc(spark, sf):
    return fl.non_negative_proc(records(spark, sf))


@query("pf17_thirtieth", f"WITH {RECORDS} SELECT * REPLACE (CASE WHEN datd = 31 THEN 30 ELSE datd END AS datd, 2 AS tim) FROM records")
def thirtieth(spark, sf):
    return ta.thirtieth(records(spark, sf).withColumn("tim", F.lit(2)))


@query(
    "pf17_monthly_means",
    f"""WITH {RECORDS}, r AS (SELECT * REPLACE (CASE WHEN model = 0 THEN 0 ELSE datd END AS datd, 2 AS tim) FROM records)
SELECT * REPLACE (CASE WHEN datd = 0 THEN 22 ELSE tim END AS tim, CASE WHEN datd = 0 THEN 1 ELSE datd END AS datd, CASE WHEN datd = 0 THEN 1950 ELSE yr END AS yr,
  CASE WHEN datd = 0 THEN CASE WHEN mond = 12 THEN 1951 ELSE 1950 END ELSE yrd END AS yrd, CASE WHEN datd = 0 THEN mond % 12 + 1 ELSE mond END AS mond) FROM r""",
)
def monthly_means(spark, sf):
    r = records(spark, sf).withColumn("tim", F.lit(2)).withColumn("datd", F.when(F.col("model") == 0, 0).otherwise(F.col("datd")))
    return ta.as_monthly_means(r)


@query("sc12_select_records", f"WITH {RECORDS} SELECT * FROM records WHERE stash = 1003 AND model IN (1, 0)")
def select_records(spark, sf):
    return fl.select_records(records(spark, sf), 1, 3)


@query("sc13_merge_records", f"WITH {RECORDS} SELECT *, CAST(dense_rank() OVER (PARTITION BY file, stash ORDER BY yr, mon, dat) - 1 AS INT) AS t, CAST(dense_rank() OVER (PARTITION BY file, stash ORDER BY model) - 1 AS INT) AS z FROM records")
def merge_records(spark, sf):
    return fl.merge_records(records(spark, sf), ["file"], ["yr", "mon", "dat"], "model")


@query("wn15_level_order", """SELECT file, pl, CAST(dense_rank() OVER (PARTITION BY file ORDER BY f) - 1 AS INT) AS "order" FROM (SELECT l_suppkey AS file, l_linenumber AS pl, min(l_orderkey * 10 + l_linenumber) AS f FROM lineitem GROUP BY ALL)""")
def level_order(spark, sf):
    li = read(spark, sf, "lineitem").select(F.col("l_suppkey").alias("file"), F.col("l_linenumber").alias("pl"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"))
    return fl.level_order(li, ["file"])


@query("sk2_record_order", f"""WITH {RECORDS} SELECT file, seq, CAST(row_number() OVER (PARTITION BY file ORDER BY yr, mon, dat, f, model, seq) AS INT) AS pos FROM (SELECT *, min(seq) OVER (PARTITION BY file, stash) AS f FROM records)""")
def record_order(spark, sf):
    out = wr.record_order(records(spark, sf).withColumnRenamed("model", "lev"), ["file"], ["yr", "mon", "dat"])
    return out.select("file", "seq", "pos")


@query("sc18_mask_from_missing", f"WITH {RECORDS}, {RASTER} SELECT r.seq, q.y, q.x, q.value IS NULL AS masked FROM records r, dims JOIN raster q ON q.y = r.seq // dims.nx AND q.x = r.seq % dims.nx WHERE stash = 1001")
def mask_from_missing(spark, sf):
    g = grid(spark, sf)
    cells = raster(spark, sf, g).withColumn("seq", F.col("y").cast("long") * g.nx + F.col("x"))
    return fl.mask_from_missing(records(spark, sf).filter("stash = 1001"), cells)


@query("sc5_mesh_corners", """SELECT l_orderkey AS face_id, list(s_acctbal ORDER BY l_linenumber, l_partkey, l_suppkey) AS lats, list(CAST(s_suppkey AS DOUBLE) ORDER BY l_linenumber, l_partkey, l_suppkey) AS lons
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY l_orderkey""")
def mesh_corners(spark, sf):
    li = read(spark, sf, "lineitem")
    ring = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", (F.col("l_suppkey") + 1).alias("n"))))
    faces = li.groupBy(F.col("l_orderkey").alias("face_id")).agg(F.transform(ring, lambda r: r["n"]).alias("nodes"))
    nodes = read(spark, sf, "supplier").select(F.col("s_suppkey").alias("node_id"), F.col("s_acctbal").alias("lat"), F.col("s_suppkey").cast("double").alias("lon"))
    return ms.face_corners(faces, nodes)


def mesh_sql(shift):
    """Three fields on the orders' places; field 2 has its longitudes shifted where `shift` holds."""
    return f"""WITH f AS (SELECT k AS field_id, CASE WHEN k = 0 THEN 'own' ELSE (SELECT min(o_orderpriority) FROM orders) END AS name, o_orderkey AS face_id, o_totalprice % 180 - 90 AS lat,
  o_totalprice % 360 + CASE WHEN k = 2 AND {shift} THEN 1.0 ELSE 0.0 END AS lon FROM orders, (SELECT unnest([0, 1, 2])::INT AS k)),
odd AS (SELECT face_id FROM f GROUP BY face_id HAVING count(*) <> 3 OR min(lat) <> max(lat) OR min(lon) <> max(lon)),
p AS (SELECT field_id, name, count(*) AS faces FROM f GROUP BY ALL)
SELECT field_id, name, faces, count(*) OVER (PARTITION BY name) = 1 AS unique_name, NOT EXISTS (SELECT 1 FROM odd) AS same_topology FROM p"""


def mesh_fields(spark, sf, shift):
    o = read(spark, sf, "orders")
    clerk = o.agg(F.min("o_orderpriority")).first()[0]
    moved = F.when((F.col("field_id") == 2) & F.expr(shift), 1.0).otherwise(0.0)
    return o.withColumn("field_id", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).select(
        "field_id", F.when(F.col("field_id") > 0, F.lit(clerk)).otherwise("own").alias("name"), F.col("o_orderkey").alias("face_id"),
        (F.col("o_totalprice") % 180 - 90).alias("lat"), (F.col("o_totalprice") % 360 + moved).alias("lon"),
    )


@query("sk7_mesh_consistency", mesh_sql("o_orderstatus = 'P'"))
def mesh_consistency(spark, sf):
    return wr.mesh_fields_consistent(mesh_fields(spark, sf, "o_orderstatus = 'P'"))


@query("sk7_mesh_consistency_equal", mesh_sql("o_orderstatus = '-'"))
def mesh_consistency_equal(spark, sf):
    return wr.mesh_fields_consistent(mesh_fields(spark, sf, "o_orderstatus = '-'"))


@query("fn1_radiation_series", f"""WITH {GASES}, s AS (SELECT gas, CAST(floor(1850 + days / 365) AS INT) AS year, value * CASE gas WHEN 'CO2' THEN 1.5188e-6 WHEN 'CH4' THEN 0.5523e-9 WHEN 'N2O' THEN 1.5188e-9 WHEN 'CFC12' THEN 4.1783e-12 ELSE 3.5219e-12 END AS v FROM (SELECT * REPLACE (days + 365 * 22 AS days) FROM gases) WHERE sector = 0),
p AS (SELECT *, lag(v) OVER w AS u, lead(v) OVER w AS n FROM s WINDOW w AS (PARTITION BY gas ORDER BY year))
SELECT gas, year, round(v * 1e6, 5) AS value FROM (SELECT gas, year, coalesce((u + v) / 2, v) AS v FROM p UNION ALL SELECT gas, year + 1, v + (v - u) / 2 FROM p WHERE n IS NULL) WHERE year BETWEEN 2015 AND 2024""")
def radiation_series(spark, sf):
    g = gases(spark, sf).withColumn("days", F.col("days") + 365 * 22)
    return gs.radiation_series(g, "scenario", 2010, 2024).withColumn("value", F.round(F.col("value") * 1e6, 5))


@query("jn20_add_species", """WITH s AS (SELECT l_returnflag || l_linestatus AS sp, CAST(l_partkey % 36 AS INT) AS y, CAST(l_orderkey % 72 AS INT) AS x, sum(l_quantity) AS v FROM lineitem GROUP BY ALL)
SELECT y, x, sum(v) AS value FROM s GROUP BY ALL HAVING count(*) = 6""")
def add_species(spark, sf):
    li = read(spark, sf, "lineitem").groupBy(
        F.concat("l_returnflag", "l_linestatus").alias("sp"), F.expr("CAST(l_partkey % 36 AS INT)").alias("y"), F.expr("CAST(l_orderkey % 72 AS INT)").alias("x"),
    ).agg(F.sum("l_quantity").alias("value"))
    return gs.add_species(li, ["y", "x"], 6)


@query("ag5_area_totals", f"""WITH {MONTHLY}, {MONTH_AXES} SELECT field_id, t, round(sum(value * 6371229.0::DOUBLE * 6371229.0::DOUBLE * (sin(radians(my.hi)) - sin(radians(my.lo))) * radians(mx.hi - mx.lo)) * (86400.0::DOUBLE * 360 / 1e12) / 1e6, 5) AS total
FROM monthly JOIN mx ON mx.idx = x JOIN my ON my.idx = y GROUP BY field_id, t""")
def area_totals(spark, sf):
    out = gs.area_totals(monthly(spark, sf), *month_axes(spark), ["field_id", "t"], gs.GIGATONNES_PER_YEAR)
    return out.withColumn("total", F.round(F.col("total") / 1e6, 5))


LISTED = "s AS (SELECT o_custkey AS gas, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) + 1990 AS INT) AS year, o_totalprice AS value FROM orders)"


@query(
    "sk8_series_listing",
    f"""WITH {LISTED}, n AS (SELECT *, row_number() OVER (PARTITION BY gas ORDER BY year) AS rn, count(*) OVER (PARTITION BY gas) AS n FROM s),
t AS (SELECT 'levls' AS section, gas, CAST((rn - 1) // 6 AS INT) AS line, string_agg(printf('%.4e', value), ',' ORDER BY rn) || CASE WHEN max(rn) < max(n) THEN ',' ELSE '' END AS x FROM n GROUP BY ALL
  UNION ALL SELECT 'years', gas, CAST((rn - 1) // 12 AS INT), string_agg(CAST(year AS VARCHAR), ',' ORDER BY rn) || CASE WHEN max(rn) < max(n) THEN ',' ELSE '' END FROM n GROUP BY gas, (rn - 1) // 12),
c AS (SELECT gas, count(*) AS n FROM s GROUP BY gas), i AS (SELECT max(n) AS n FROM c)
SELECT section, CAST(gas AS VARCHAR) AS gas, line, CASE WHEN line = 0 THEN 'clim_fcg_' || section || '_' || gas || '=' ELSE '    =' END || x AS text FROM t
UNION ALL SELECT 'nyears', CAST(gas AS VARCHAR), 0, 'clim_fcg_nyears_' || gas || '=' || n FROM c UNION ALL SELECT 'rates', CAST(gas AS VARCHAR), 0, 'clim_fcg_rates_' || gas || '=' || n || '*-32768.0' FROM c
UNION ALL SELECT 'levls', 'SO4', 0, 'clim_fcg_levls_so4=' || n || '*-32768.0' FROM i UNION ALL SELECT 'nyears', 'SO4', 0, 'clim_fcg_nyears_so4=0' FROM i
UNION ALL SELECT 'rates', 'SO4', 0, 'clim_fcg_rates_so4=' || n || '*-32768.0' FROM i UNION ALL SELECT 'years', 'SO4', 0, 'clim_fcg_years_so4=' || n || '*-32768' FROM i""",
)
def series_listing(spark, sf):
    rn = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    s = read(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("gas"), (rn + 1990).alias("year"), F.col("o_totalprice").alias("value"))
    return wr.series_listing(s, ["SO4"])


WIDE = ["DUMM0", "CO2", "CH4", "N2O", "CFC_12", "HALON1211", "HALON1202"]
WIDE_SQL = f"""{GASES}, named AS (SELECT sector, CAST(floor(1850 + days / 365) AS INT) AS year, CASE gas WHEN 'CFC12' THEN 'CFC_12' WHEN 'HFC134A' THEN 'HALON1211' ELSE gas END AS gas, round(value, 3) AS value FROM gases),
wide AS (SELECT sector, year, max(value) FILTER (gas = 'CO2') AS co2, max(value) FILTER (gas = 'CH4') AS ch4, max(value) FILTER (gas = 'N2O') AS n2o, max(value) FILTER (gas = 'CFC_12') AS c12, max(value) FILTER (gas = 'HALON1211') AS h FROM named GROUP BY ALL)"""


def named_gases(spark, sf):
    name = F.when(F.col("gas") == "CFC12", "CFC_12").when(F.col("gas") == "HFC134A", "HALON1211").otherwise(F.col("gas"))
    return gases(spark, sf).select("sector", F.floor(1850 + F.col("days") / 365).cast("int").alias("year"), name.alias("gas"), F.round("value", 3).alias("value"))


@query("sk9_wide_table", f"WITH {WIDE_SQL} SELECT sector, year, c12 * -1e6 AS DUMM0, co2 AS CO2, ch4 AS CH4, n2o AS N2O, c12 AS CFC_12, h AS HALON1211, h * 0 AS HALON1202 FROM wide")
def wide_table(spark, sf):
    return wr.wide_table(named_gases(spark, sf), WIDE, ["sector"])


@query("sk9_wide_lines", f"WITH {WIDE_SQL} SELECT year, printf('   %d    %.4e    %.4e    %.4e    %.4e    %.4e    %.4e    %.4e', year, c12 * -1e6, co2, ch4, n2o, c12, h, h * 0) AS text FROM wide WHERE sector = 0")
def wide_lines(spark, sf):
    return wr.wide_lines(wr.wide_table(named_gases(spark, sf).filter("sector = 0"), WIDE), WIDE)


SEG = f"""{LEVELS}, seg AS (SELECT y, x, height AS h, value AS v, lead(height) OVER w AS h1, lead(value) OVER w AS v1, lag(height) OVER w AS hp, lag(value) OVER w AS vp FROM levels WINDOW w AS (PARTITION BY y, x ORDER BY height)),
t AS (SELECT * FROM (VALUES (0, 90.0::DOUBLE), (1, 205.5::DOUBLE), (2, 380.0::DOUBLE), (3, 777.0::DOUBLE)) t(level, z)),
hit AS (SELECT * FROM seg, t WHERE (z >= h AND (h1 IS NULL OR z < h1)) OR (hp IS NULL AND z < h))"""


def level_query(method, extrapolation, below, above, inner="v + (z - h) / (h1 - h) * (v1 - v)"):
    sql = f"""WITH {RASTER}, {SEG} SELECT y, x, level, z, round(CASE WHEN hp IS NULL AND z < h THEN {below} WHEN h1 IS NULL AND z > h THEN {above} WHEN z = h THEN v ELSE {inner} END, 9) AS value FROM hit"""

    @query(f"jn8_{method}_{extrapolation}", sql)
    def run(spark, sf):
        out = vt.relevel(levels(spark, sf), [90.0, 205.5, 380.0, 777.0], ["y", "x"], method=method, extrapolation=extrapolation)
        return out.withColumn("value", F.round("value", 9))

    return run


NAN = "CAST('NaN' AS DOUBLE)"
level_query("linear", "nearest", "v", "v")
level_query("linear", "nan", NAN, NAN)
level_query("linear", "linear", "v + (z - h) / (h1 - h) * (v1 - v)", "CASE WHEN hp IS NULL THEN v ELSE vp + (z - hp) / (h - hp) * (v - vp) END")
level_query("nearest", "nearest", "v", "v", "CASE WHEN z - h <= h1 - z THEN v ELSE v1 END")


@query(
    "jn8_column_targets",
    f"""WITH {RASTER}, {LEVELS}, seg AS (SELECT y, x, height AS h, value AS v, lead(height) OVER w AS h1, lead(value) OVER w AS v1, lag(height) OVER w AS hp, first_value(height) OVER w AS h0 FROM levels WINDOW w AS (PARTITION BY y, x ORDER BY height)),
hit AS (SELECT *, h0 + 130.0 * level + 10 AS z FROM seg, (SELECT unnest([0, 1, 2])::INT AS level))
SELECT y, x, level, z, round(CASE WHEN h1 IS NULL OR z = h THEN v ELSE v + (z - h) / (h1 - h) * (v1 - v) END, 9) AS value FROM hit WHERE z >= h AND (h1 IS NULL OR z < h1)""",
)
def column_targets(spark, sf):
    lv = levels(spark, sf)
    h0 = F.min("height").over(Window.partitionBy("y", "x"))
    t = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.struct(i.alias("idx"), (h0 + i * 130.0 + 10).alias("z")))
    return vt.relevel(lv.withColumn("targets", t), "targets", ["y", "x"]).withColumn("value", F.round("value", 9))


@query(
    "jn9_conservative_levels",
    f"""WITH {RASTER}, {LEVELS}, b AS (SELECT y, x, value, height - 40 AS a, height + 35 AS b FROM levels), t AS (SELECT * FROM (VALUES (0, 0.0::DOUBLE, 250.0::DOUBLE), (1, 250.0::DOUBLE, 500.0::DOUBLE), (2, 500.0::DOUBLE, 900.0::DOUBLE)) t(level, lo, hi))
SELECT y, x, level, round(sum(value * (least(b, hi) - greatest(a, lo))) / sum(least(b, hi) - greatest(a, lo)), 5) AS value FROM b, t WHERE b > lo AND a < hi GROUP BY y, x, level""",
)
def conservative_levels(spark, sf):
    lv = levels(spark, sf).withColumn("z_lo", F.col("height") - 40).withColumn("z_hi", F.col("height") + 35)
    out = vt.relevel_conservative(lv, [(0, 250), (250, 500), (500, 900)], ["y", "x"])
    return out.withColumn("value", F.round("value", 5))


@query("sc3_target_grid", f"""WITH {RASTER} SELECT y, x, level, height, sigma, round(height + sigma * price, 4) AS altitude FROM raster, (VALUES (1, 20.0::DOUBLE, 0.75::DOUBLE), (2, 80.0::DOUBLE, 0.25::DOUBLE)) t(level, height, sigma)""")
def target_grid(spark, sf):
    g = grid(spark, sf)
    lv = spark.createDataFrame([(1, 20.0, 0.75), (2, 80.0, 0.25)], "level INT, height DOUBLE, sigma DOUBLE")
    oro = raster(spark, sf, g).select("y", "x", F.col("price").alias("surface_altitude"))
    out = fl.load_grid(*axes(spark, g), lv, oro).filter("altitude IS NOT NULL")
    return out.select("y", "x", "level", "height", "sigma", F.round("altitude", 4).alias("altitude"))


@query(
    "qa1_compare_fields",
    f"""WITH {MONTHLY}, b AS (SELECT field_id, t, y, x, CASE WHEN x % 9 = 0 THEN value + 1 WHEN x % 9 = 1 THEN NULL ELSE value END AS value FROM monthly WHERE y <> 3)
SELECT coalesce(a.field_id, b.field_id) AS field_id, count(*) AS cells, count_if(a.field_id IS NULL) AS only_right, count_if(b.field_id IS NULL) AS only_left,
  count_if(a.field_id IS NOT NULL AND b.field_id IS NOT NULL AND a.value IS DISTINCT FROM b.value) AS differing, round(max(abs(a.value - b.value)), 6) AS largest
FROM (SELECT * FROM monthly WHERE t <> 7) a FULL JOIN b ON a.field_id = b.field_id AND a.t = b.t AND a.y = b.y AND a.x = b.x GROUP BY 1""",
)
def compare_fields(spark, sf):
    m = monthly(spark, sf)
    b = m.filter("y <> 3").withColumn("value", F.when(F.col("x") % 9 == 0, F.col("value") + 1).when(F.col("x") % 9 != 1, F.col("value")))
    out = ck.compare_fields(m.filter("t <> 7"), b, ["field_id", "t", "y", "x"], by=["field_id"])
    return out.withColumn("largest", F.round("largest", 6))


@query("qa1_first_differences", f"""WITH {RASTER} SELECT y, x, price AS "left", CASE WHEN status <> 'F' THEN price ELSE price + 1 END AS "right" FROM raster WHERE status = 'F' ORDER BY y, x LIMIT 5""")
def first_differences(spark, sf):
    r = raster(spark, sf)
    return ck.first_differences(r, r.withColumn("price", F.when(F.col("status") == "F", F.col("price") + 1).otherwise(F.col("price"))), ["y", "x"], 5, "price")


@query("qa1_compare_attributes", """SELECT p_partkey AS field_id, 'size' AS name, CAST(p_size AS VARCHAR) AS "left", CAST(p_size + 1 AS VARCHAR) AS "right" FROM part WHERE p_size > 25""")
def compare_attributes(spark, sf):
    p = read(spark, sf, "part")

    def table(size, note):
        rows = F.explode(F.array(F.struct(F.lit("size").alias("name"), size.cast("string").alias("text")), F.struct(F.lit("history").alias("name"), F.lit(note).alias("text"))))
        return p.select(F.col("p_partkey").alias("field_id"), rows.alias("r")).select("field_id", "r.*")

    return ck.compare_attributes(table(F.col("p_size"), "a"), table(F.when(F.col("p_size") > 25, F.col("p_size") + 1).otherwise(F.col("p_size")), "b"))


@query("qa2_compare_series", f"""WITH {WIDE_SQL} SELECT year, gas, round(source, 3) AS source, product, round(product - source, 3) AS difference FROM (
  SELECT n.year, n.gas, CASE n.gas WHEN 'CO2' THEN w.value * 0.5 ELSE w.value END AS source, n.value AS product FROM named n JOIN named w ON w.year = n.year AND w.gas = n.gas AND w.sector = 1 WHERE n.sector = 0)""")
def compare_series(spark, sf):
    n = named_gases(spark, sf)
    names = ["CO2", "CH4", "N2O", "CFC_12", "HALON1211"]
    wide = wr.wide_table(n.filter("sector = 1"), names)
    out = ck.compare_series(wide, n.filter("sector = 0"), names, {"CO2": 0.5})
    return out.select("year", "gas", F.round("source", 3).alias("source"), "product", F.round("difference", 3).alias("difference"))


def whole_raster(spark, sf, g, value):
    """The raster with its incomplete last row filled up."""
    r = raster(spark, sf, g).select("y", "x", value.alias("value"))
    return complete(r, g.ny, g.nx).withColumn("value", F.coalesce("value", F.lit(1000.0)))


@query("wn13_low_pass_filter")
def low_pass_filter(spark, sf):
    g = grid(spark, sf)
    lat = -90 + (F.col("y") + 0.5) * 180.0 / g.ny
    eps = ft.strength_by_latitude(2.0e6, lat, 360.0 / g.nx, 180.0 / g.ny)
    return ft.raymond_filter(whole_raster(spark, sf, g, F.col("price")), g.ny, g.nx, ft.strength_from_length(2.0e6, 360.0 / g.nx), eps)


#: The field as whole numbers, and minus its sixth difference along one axis: every cell is counted at seven places.
FLAT = f"""{RASTER}, d AS (SELECT CAST(i // nx AS INT) AS y, CAST(i % nx AS INT) AS x, coalesce(floor(price / 1000), 1000) AS v, nx, ny FROM dims, range((SELECT nx * ny FROM dims)) g(i)
  LEFT JOIN (SELECT y AS ry, x AS rx, price FROM raster) r ON r.ry = i // nx AND r.rx = i % nx),
s AS (SELECT * FROM (VALUES (-3, 1), (-2, -6), (-1, 15), (0, -20), (1, 15), (2, -6), (3, 1)) t(k, c))"""


@query("wn13_row_equation", f"WITH {FLAT} SELECT y, CAST((x + k + nx) % nx AS INT) AS x, CAST(sum(c * v) AS BIGINT) AS moved FROM d, s GROUP BY ALL")
def row_equation(spark, sf):
    """The rows' filter is an equation: its left side on what the filter changed is its right side on the field, here whole numbers."""
    g = grid(spark, sf)
    return filter_equation(spark, sf, g, "x", ft.raymond_filter(whole_raster(spark, sf, g, F.floor(F.col("price") / 1000).cast("double")), g.ny, g.nx, 1.0, along=("x",)))


@query("wn13_column_equation", f"WITH {FLAT} SELECT CAST(y + k AS INT) AS y, x, CAST(sum(c * v) AS BIGINT) AS moved FROM d, s WHERE y + k BETWEEN 3 AND ny - 4 GROUP BY ALL")
def column_equation(spark, sf):
    """As for the rows, three cells away from the open ends, where the order of the difference is full."""
    g = grid(spark, sf)
    return filter_equation(spark, sf, g, "y", ft.raymond_filter(whole_raster(spark, sf, g, F.floor(F.col("price") / 1000).cast("double")), g.ny, g.nx, 1.0, along=("y",)))


def filter_equation(spark, sf, g, along, out):
    """Left side of the filter of strength one: unknowns at odd offsets drop out, those at even ones count twice their binomials."""
    before = whole_raster(spark, sf, g, F.floor(F.col("price") / 1000).cast("double")).withColumnRenamed("value", "old")
    d = out.join(before, ["y", "x"]).select("y", "x", (F.col("value") - F.col("old")).alias("v"))
    shifts = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(w).alias("w")) for k, w in ((-2, 12.0), (0, 40.0), (2, 12.0))]))
    t = d.withColumn("s", shifts).withColumn("v", F.col("v") * F.col("s.w"))
    if along == "x":
        t = t.withColumn("x", F.pmod(F.col("x") + F.col("s.k"), F.lit(g.nx)).cast("int"))
    else:
        t = t.withColumn("y", (F.col("y") + F.col("s.k")).cast("int"))
    left = t.groupBy("y", "x").agg(F.round(F.sum("v")).cast("long").alias("moved"))
    return left if along == "x" else left.filter(F.col("y").between(3, g.ny - 4))


def tile_mean(pdf: pd.DataFrame) -> pd.DataFrame:
    """Mean over the 3x3 neighbourhood, for the tile's own cells."""
    s = pdf.set_index(["y", "x"])["value"]
    own = pdf[pdf["_own"]]
    total = sum(s.reindex(pd.MultiIndex.from_arrays([own["y"] + dy, own["x"] + dx])).fillna(0).to_numpy() for dy in (-1, 0, 1) for dx in (-1, 0, 1))
    return pd.DataFrame({"y": own["y"], "x": own["x"], "total": total})


@query(
    "ud1_tiled_operation",
    f"""WITH {RASTER}, off AS (SELECT dy, dx FROM (SELECT unnest([-1, 0, 1]) AS dy), (SELECT unnest([-1, 0, 1]) AS dx))
SELECT a.y, a.x, sum(coalesce(b.value, 0)) AS total FROM raster a, off LEFT JOIN raster b ON b.y = a.y + dy AND b.x = (a.x + dx + a.nx) % a.nx GROUP BY a.y, a.x""",
)
def tiled_operation(spark, sf):
    g = grid(spark, sf)
    return tl.apply_tiled(raster(spark, sf, g).select("y", "x", "value"), tile_mean, "y INT, x INT, total DOUBLE", g.ny, g.nx, tl.tile_shape(g.ny, g.nx, 2000), halo=1)


def pair_difference(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    m = a.merge(b, on=["y", "x"], suffixes=("", "_b"))
    return pd.DataFrame({"y": m["y"], "x": m["x"], "diff": m["price"] - m["land"]})


@query("ud1_tiled_pair", f"WITH {RASTER} SELECT y, x, price - land AS diff FROM raster")
def tiled_pair(spark, sf):
    g = grid(spark, sf)
    r = raster(spark, sf, g)
    return tl.apply_tiled_pair(r.select("y", "x", "price"), r.select("y", "x", "land"), pair_difference, "y INT, x INT, diff DOUBLE", g.ny, g.nx, tl.tile_shape(g.ny, g.nx, 2000))
