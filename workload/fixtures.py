"""Grids derived from the given tables, as Spark DataFrames and as SQL for the oracle.

Cell numbers come from keys, so that the number of cells grows with the tables: order ``k`` is cell
``(k div nx, k mod nx)`` of a 2:1 global grid sized to hold all orders, line items add levels to it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.session import deal, within_tasks
from gridloom.sources.axes import regular_axis


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@dataclass(frozen=True)
class Grid:
    nx: int
    ny: int


def grid(spark: SparkSession, sf: str) -> Grid:
    n = read(spark, sf, "orders").agg(F.max("o_orderkey")).first()[0] + 1
    nx = math.ceil(math.sqrt(2.0 * n))
    return Grid(nx, math.ceil(n / nx))


def raster(spark: SparkSession, sf: str, g: Grid | None = None) -> DataFrame:
    """One row per order: masked for low priority, with a class code, a land flag and a runoff."""
    g = g or grid(spark, sf)
    o = read(spark, sf, "orders")
    y, x = F.expr(f"CAST(o_orderkey DIV {g.nx} AS INT)"), F.expr(f"CAST(o_orderkey % {g.nx} AS INT)")
    block = F.expr("CAST(((y DIV 4) * 5 + (x DIV 6) * 3) % 6 AS INT)")
    return o.select(
        y.alias("y"), x.alias("x"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.floor(F.col("o_totalprice") / 1000).cast("double")).alias("value"),
        F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"), F.col("o_custkey").alias("cust"),
    ).select(
        "*",
        F.when(F.col("priority") == "1-URGENT", 6).otherwise(block).alias("code"),
        F.expr("CASE WHEN ((y DIV 6) + (x DIV 9)) % 2 = 0 THEN 1 ELSE 0 END").alias("land"),
    )


RASTER = """dims AS (SELECT nx, CAST(ceil(n / nx) AS BIGINT) AS ny FROM (
  SELECT max(o_orderkey) + 1 AS n, CAST(ceil(sqrt(2.0 * (max(o_orderkey) + 1))) AS BIGINT) AS nx FROM orders)),
raster AS (SELECT *, CASE WHEN priority = '1-URGENT' THEN 6 ELSE CAST(((y // 4) * 5 + (x // 6) * 3) % 6 AS INT) END AS code,
  CASE WHEN ((y // 6) + (x // 9)) % 2 = 0 THEN 1 ELSE 0 END AS land FROM (
  SELECT CAST(o_orderkey // nx AS INT) AS y, CAST(o_orderkey % nx AS INT) AS x,
    CASE WHEN o_orderpriority <> '5-LOW' THEN floor(o_totalprice / 1000) END AS value,
    o_orderpriority AS priority, o_orderstatus AS status, o_totalprice AS price, o_custkey AS cust, nx, ny
  FROM orders, dims))"""


def axes(spark: SparkSession, g: Grid) -> tuple[DataFrame, DataFrame]:
    return regular_axis(spark, g.ny, -90.0, 180.0 / g.ny), regular_axis(spark, g.nx, -180.0, 360.0 / g.nx)


AXES = """ax AS (SELECT CAST(i AS INT) AS idx, -180.0::DOUBLE + (i + 0.5::DOUBLE) * (360.0::DOUBLE / nx) AS point,
  -180.0::DOUBLE + i * (360.0::DOUBLE / nx) AS lo, -180.0::DOUBLE + (i + 1) * (360.0::DOUBLE / nx) AS hi
  FROM dims, range((SELECT nx FROM dims)) r(i)),
ay AS (SELECT CAST(i AS INT) AS idx, -90.0::DOUBLE + (i + 0.5::DOUBLE) * (180.0::DOUBLE / ny) AS point,
  -90.0::DOUBLE + i * (180.0::DOUBLE / ny) AS lo, -90.0::DOUBLE + (i + 1) * (180.0::DOUBLE / ny) AS hi
  FROM dims, range((SELECT ny FROM dims)) r(i))"""


def axis_sql(name: str, n: int | str, start: float, step: str) -> str:
    return f"""{name} AS (SELECT CAST(i AS INT) AS idx, {start}::DOUBLE + (i + 0.5::DOUBLE) * ({step}) AS point,
  {start}::DOUBLE + i * ({step}) AS lo, {start}::DOUBLE + (i + 1) * ({step}) AS hi FROM range({n}) r(i))"""


MONTH_NY, MONTH_NX = 36, 72


def monthly(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly fields, one per supplier, on a 5 degree grid; sparse rows, t = months since 1995-01.

    Cells are nearly as many as line items, so they are dealt out by field, which serves what is grouped by field and time afterwards.
    """
    li = read(spark, sf, "lineitem")
    t = (F.year("l_shipdate") - 1995) * 12 + F.month("l_shipdate") - 1
    cells = li.select(
        F.col("l_suppkey").alias("field_id"), t.alias("t"),
        F.expr("CAST(l_partkey % 36 AS INT)").alias("y"), F.expr("CAST(l_orderkey % 72 AS INT)").alias("x"), "l_quantity",
    )
    return deal(cells, li.count(), "field_id").groupBy("field_id", "t", "y", "x").agg(F.avg("l_quantity").alias("value"))


MONTHLY = """monthly AS (SELECT l_suppkey AS field_id, CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) - 1 AS INT) AS t,
  CAST(l_partkey % 36 AS INT) AS y, CAST(l_orderkey % 72 AS INT) AS x, avg(l_quantity) AS value FROM lineitem GROUP BY ALL)"""


def month_axes(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    return regular_axis(spark, 36, -90.0, 5.0), regular_axis(spark, 72, -180.0, 5.0)


MONTH_AXES = axis_sql("my", 36, -90.0, "5.0::DOUBLE") + ",\n" + axis_sql("mx", 72, -180.0, "5.0::DOUBLE")


def levels(spark: SparkSession, sf: str, g: Grid | None = None) -> DataFrame:
    """Columns of up to seven levels: line numbers of an order, with heights that differ from column to column."""
    g = g or grid(spark, sf)
    li = read(spark, sf, "lineitem")
    return (
        li.groupBy("l_orderkey", F.col("l_linenumber").alias("z"))
        .agg(F.avg("l_quantity").alias("value"))
        .select(
            F.expr(f"CAST(l_orderkey DIV {g.nx} AS INT)").alias("y"),
            F.expr(f"CAST(l_orderkey % {g.nx} AS INT)").alias("x"),
            "z",
            (F.col("z") * 100.0 + F.expr("l_orderkey % 50")).alias("height"),
            "value",
        )
    )


LEVELS = """levels AS (SELECT CAST(l_orderkey // nx AS INT) AS y, CAST(l_orderkey % nx AS INT) AS x, l_linenumber AS z,
  l_linenumber * 100.0::DOUBLE + l_orderkey % 50 AS height, avg(l_quantity) AS value
  FROM lineitem, dims GROUP BY l_orderkey, l_linenumber, nx)"""


def tiles(spark: SparkSession, sf: str, g: Grid | None = None) -> DataFrame:
    """Class fractions (quantity / 1024, an exact scaling) per cell and class level 0..9, from the line items of an order."""
    g = g or grid(spark, sf)
    li = read(spark, sf, "lineitem")
    cells = li.select(
        F.expr(f"CAST(l_orderkey DIV {g.nx} AS INT)").alias("y"), F.expr(f"CAST(l_orderkey % {g.nx} AS INT)").alias("x"),
        F.expr("CAST(l_partkey % 10 AS INT)").alias("pl"), "l_quantity",
    )
    # A cell has few items of a class, so they are dealt out as they are; what looks at whole cells afterwards needs no further shuffle.
    per = within_tasks(cells, li.count(), "y", "x").groupBy("y", "x", "pl").agg(F.sum("l_quantity").alias("q"))
    return per.select("y", "x", "pl", (F.col("q") / 1024).alias("value"))


TILES = """tiles AS (SELECT CAST(l_orderkey // nx AS INT) AS y, CAST(l_orderkey % nx AS INT) AS x,
  CAST(l_partkey % 10 AS INT) AS pl, sum(l_quantity) / 1024 AS value FROM lineitem, dims GROUP BY l_orderkey, l_partkey % 10, nx)"""


def records(spark: SparkSession, sf: str) -> DataFrame:
    """Record headers, one per order: item code, validity times and processing code."""
    o = read(spark, sf, "orders")
    nxt = F.add_months(F.col("o_orderdate"), 1)
    return o.select(
        F.col("o_custkey").alias("file"), F.col("o_orderkey").alias("seq"),
        F.expr("CAST(1000 + o_orderkey % 5 AS INT)").alias("stash"),
        F.expr("CAST(o_orderkey % 3 AS INT)").alias("model"),
        F.year("o_orderdate").alias("yr"), F.month("o_orderdate").alias("mon"), F.dayofmonth("o_orderdate").alias("dat"),
        F.year(nxt).alias("yrd"), F.month(nxt).alias("mond"), F.dayofmonth(nxt).alias("datd"),
        F.when(F.col("o_orderstatus") == "P", -32768).otherwise(128).alias("proc"),
        F.lit(12).alias("tim"),
    )


RECORDS = """records AS (SELECT o_custkey AS file, o_orderkey AS seq, CAST(1000 + o_orderkey % 5 AS INT) AS stash,
  CAST(o_orderkey % 3 AS INT) AS model, CAST(year(o_orderdate) AS INT) AS yr, CAST(month(o_orderdate) AS INT) AS mon, CAST(day(o_orderdate) AS INT) AS dat,
  CAST(year(o_orderdate + INTERVAL 1 MONTH) AS INT) AS yrd, CAST(month(o_orderdate + INTERVAL 1 MONTH) AS INT) AS mond, CAST(day(o_orderdate + INTERVAL 1 MONTH) AS INT) AS datd,
  CASE WHEN o_orderstatus = 'P' THEN -32768 ELSE 128 END AS proc, 12 AS tim FROM orders)"""


def gases(spark: SparkSession, sf: str) -> DataFrame:
    """Mole fractions per gas, sector and day: ``days`` since 1850 in 365-day years."""
    o = read(spark, sf, "orders")
    gas = F.expr("element_at(array('CO2','CH4','N2O','CFC12','HFC134A'), CAST(left(o_orderpriority, 1) AS INT))")
    return o.groupBy(
        gas.alias("gas"), F.expr("CAST(o_custkey % 3 AS INT)").alias("sector"),
        ((F.year("o_orderdate") - 1850) * 365 + 182).cast("double").alias("days"),
    ).agg(F.avg("o_totalprice").alias("value"))


GASES = """gases AS (SELECT ['CO2','CH4','N2O','CFC12','HFC134A'][CAST(left(o_orderpriority, 1) AS INT)] AS gas,
  CAST(o_custkey % 3 AS INT) AS sector, CAST((year(o_orderdate) - 1850) * 365 + 182 AS DOUBLE) AS days, avg(o_totalprice) AS value
  FROM orders GROUP BY ALL)"""
