"""Round trips through files written to the shared folder: fields, gas files, rasters, text."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gridloom.operators.regrid import complete
from gridloom.session import shared_folder
from gridloom.sinks import writers as wr
from gridloom.sources import fields as fl
from gridloom.sources.raster import bil_cells, read_ascii_grids
from workload.fixtures import GASES, MONTHLY, RASTER, gases, grid, monthly, raster
from workload.registry import query


def new_folder(spark) -> str:
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


@query("sc1_load_fields", f"WITH {RASTER} SELECT 'price' AS name, y, x, price AS value FROM raster")
def load_fields(spark, sf):
    r = raster(spark, sf)
    path = new_folder(spark)
    both = r.select(F.lit("price").alias("name"), "y", "x", F.col("price").alias("value"), F.lit(0).alias("forecast_reference_time"))
    both.unionByName(r.select(F.lit("masked").alias("name"), "y", "x", "value", F.lit(0).alias("forecast_reference_time"))).write.partitionBy("name").parquet(path)
    return fl.load_fields(spark, path, ["price"]).select("name", "y", "x", "value")


@query("sk1_write_fields", f"WITH {MONTHLY} SELECT field_id % 10 AS field_id, t, y, x, CAST(max(value) AS FLOAT) AS value FROM monthly GROUP BY ALL")
def write_fields(spark, sf):
    path = new_folder(spark)
    ten = monthly(spark, sf).groupBy((F.col("field_id") % 10).alias("field_id"), "t", "y", "x").agg(F.max("value").alias("value"))
    wr.write_fields(ten, path, to="float")
    return spark.read.parquet(path).select(F.col("field_id").cast("long").alias("field_id"), "t", "y", "x", "value")


@query("sc14_gas_files", f"WITH {GASES} SELECT gas, round(days / 365 + 1850, 6) AS year, round(value, 4) AS value FROM gases WHERE sector = 0")
def gas_files(spark, sf):
    path = new_folder(spark)
    gases(spark, sf).write.partitionBy("gas").parquet(path)
    out = fl.gas_samples(spark, {g: f"{path}/gas={g}" for g in ("CO2", "CH4", "N2O", "CFC12", "HFC134A")}, 1850, 365.0)
    return out.select("gas", F.round("year", 6).alias("year"), F.round("value", 4).alias("value"))


TILE_ROWS = 20


@query(
    "sc4_ascii_grids",
    f"""WITH {RASTER} SELECT g.i // (nx * {TILE_ROWS}) AS tile, CAST(g.i // nx % {TILE_ROWS} AS INT) AS y, CAST(g.i % nx AS INT) AS x, g.i // nx + 0.5::DOUBLE AS lat, g.i % nx + 0.5::DOUBLE AS lon, r.value
FROM dims, range((SELECT nx * {TILE_ROWS} * CAST(ceil(ny / {TILE_ROWS}.0) AS BIGINT) FROM dims)) g(i) LEFT JOIN (SELECT y AS ry, x AS rx, value FROM raster) r ON r.ry = g.i // nx AND r.rx = g.i % nx""",
)
def ascii_grids(spark, sf):
    """The raster written as ASCII grids of twenty rows each, and read back."""
    g = grid(spark, sf)
    tiles = -(-g.ny // TILE_ROWS)
    cells = complete(raster(spark, sf, g).select("y", "x", "value"), tiles * TILE_ROWS, g.nx)
    tile = F.expr(f"y DIV {TILE_ROWS}")
    row = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x", F.coalesce("value", F.lit(-99.0)).alias("v")))), lambda c: c["v"].cast("string")), " ")
    body = cells.groupBy(tile.alias("tile"), "y").agg(row.alias("value")).select("tile", (F.lit(10) - F.col("y")).alias("ord"), "value")
    head = cells.select(tile.alias("tile")).distinct().withColumn("south", F.col("tile") * TILE_ROWS)
    lines = [f"concat('ncols ', {g.nx})", f"concat('nrows ', {TILE_ROWS})", "'xllcorner 0'", "concat('yllcorner ', south)", "'cellsize 1'", "'NODATA_value -99'"]
    head = head.selectExpr("tile", f"posexplode(array({', '.join(lines)})) AS (ord, value)").select("tile", (F.col("ord") - 1_000_000_000).cast("long").alias("ord"), "value")
    path = new_folder(spark)
    text = body.withColumn("ord", F.col("ord").cast("long")).unionByName(head)
    text.repartition("tile").sortWithinPartitions("tile", "ord").select("tile", "value").write.partitionBy("tile").text(path)
    out = read_ascii_grids(spark, f"{path}/*/part-*")
    return out.select(F.regexp_extract("path", r"tile=(\d+)", 1).cast("long").alias("tile"), "y", "x", "lat", "lon", "value")


@query("sc4_bil_raster", f"""WITH {RASTER} SELECT CAST(i // nx AS INT) AS y, CAST(i % nx AS INT) AS x, i // nx + 0.5::DOUBLE AS lat, i % nx + 0.5::DOUBLE AS lon, CASE WHEN code <> 6 THEN code + 65.0::DOUBLE END AS value
FROM dims, range((SELECT nx * ny FROM dims)) g(i) LEFT JOIN (SELECT y AS ry, x AS rx, code FROM raster) r ON r.ry = i // nx AND r.rx = i % nx""")
def bil_raster(spark, sf):
    """The class codes as one-byte pixels A to G, a row of the raster per line of text; the line ends are row padding."""
    g = grid(spark, sf)
    cells = complete(raster(spark, sf, g).select("y", "x", "code"), g.ny, g.nx, None, "code")
    pixel = F.expr("char(65 + coalesce(code, 6))")
    line = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x", pixel.alias("p")))), lambda c: c["p"]), "")
    path = new_folder(spark)
    rows = cells.groupBy("y").agg(line.alias("value"))
    rows.repartitionByRange(4, F.desc("y")).sortWithinPartitions(F.desc("y")).select("value").write.text(path)
    parts = sorted(r[0] for r in spark.read.format("binaryFile").load(path).select("path").collect())
    header = f"NROWS {g.ny}\nNCOLS {g.nx}\nNBITS 8\nTOTALROWBYTES {g.nx + 1}\nULXMAP 0.5\nULYMAP {g.ny - 0.5}\nXDIM 1\nYDIM 1\nNODATA {65 + 6}\n"
    return bil_cells(spark, parts, header).select("y", "x", "lat", "lon", "value")
