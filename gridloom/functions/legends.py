"""Class legends: flag lists of fields and the fixed legends of three land-cover products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def flag_meanings(text: Column) -> Column:
    """Flag meanings from one string, separated by the first of , ; : or blank that occurs; lower case, no empties."""
    sep = (
        F.when(F.instr(text, ",") > 0, F.split(text, ","))
        .when(F.instr(text, ";") > 0, F.split(text, ";"))
        .when(F.instr(text, ":") > 0, F.split(text, ":"))
        .otherwise(F.split(text, r"\s+"))
    )
    return F.filter(F.transform(sep, lambda s: F.lower(F.trim(s))), lambda s: s != "")


def flag_table(fields: DataFrame, values: str = "flag_values", meanings: str = "flag_meanings", by: list[str] | None = None, strict: bool = True) -> DataFrame:
    """One row per flag from array and text attributes; lengths must match and values must be whole numbers."""
    f = fields.withColumn("_m", flag_meanings(F.col(meanings)))
    if strict:
        bad = (F.size("_m") != F.size(values)) | F.exists(values, lambda v: v != F.floor(v))
        if f.filter(bad).limit(1).count():
            raise ValueError("flag values and meanings do not belong together")
    z = f.withColumn("_z", F.explode(F.arrays_zip(F.col(values).alias("v"), F.col("_m").alias("m"))))
    return z.select(*(by or []), F.col("_z.v").cast("int").alias("flag_value"), F.col("_z.m").alias("flag_meaning"))


# Codes and names of the ESA CCI, IGBP and ITE land-cover legends.
CCI_VALUES = [
    10, 11, 12, 20, 30, 40, 50, 60, 61, 62, 70, 71, 72, 80, 81, 82, 90, 100, 110, 120, 121, 122,
    -126, -116, -106, -105, -104, -103, -96, -86, -76, -66, -56, -55, -54, -46, -45, -36, -47,
]
CCI_MEANINGS = """
cropland_rainfed herbaceous_cover tree_or_shrub_cover cropland_irrigated mosaic_cropland mosaic_natural_vegetation
tree_broadleaved_evergreen_closed_to_open tree_broadleaved_deciduous_closed_to_open tree_broadleaved_deciduous_closed
tree_broadleaved_deciduous_open tree_needleleaved_evergreen_closed_to_open tree_needleleaved_evergreen_closed
tree_needleleaved_evergreen_open tree_needleleaved_deciduous_closed_to_open tree_needleleaved_deciduous_closed
tree_needleleaved_deciduous_open tree_mixed mosaic_tree_and_shrub mosaic_herbaceous shrubland shrubland_evergreen
shrubland_dedicious grassland lichens_and_mosses sparse_vegetation sparse_tree sparse_shrub sparse_herbaceous
tree_cover_flooded_fresh_or_brakish_water tree_cover_flooded_saline_water shrub_or_herbaceous_cover_flooded urban
bare_areas consolidated_bare_areas unconsolidated_bare_areas water_bodies sea_ocean_water snow_and_ice resolved_lake
"""
IGBP_MEANINGS = """
ocean evergreen_needleleaf_forest evergreen_broadleaf_forest deciduous_needleleaf_forest deciduous_broadleaf_forest
mixed_forest closed_shrublands open_shrublands woody_savannas savannas grasslands permanent_wetlands croplands
urban_and_built-up cropland_or_natural_vegetation_mosaic snow_and_ice barren_or_sparsely_vegetated water_bodies
"""
ITE_MEANINGS = """
sea_or_estuary inland_water beach_and_coastal_bare saltmarsh grass_heath mown_or_grazed_turf
meadow_or_verge_meadow_or_verge_or_semi-natural rough_or_marsh_grass moorland_grass open_shrub_moor dense_shrub_moor
bracken dense_shrub_heath scrub_or_orchard deciduous_woodland coniferous_woodland upland_bog tilled_land ruderal_weed
suburban_or_rural_development continuous_urban inland_bare_ground felled_forest lowland_bog open_shrub_heath
"""


def legend(spark: SparkSession, product: str) -> DataFrame:
    """Fixed legend ``(flag_value, flag_meaning)`` of 'cci', 'igbp' or 'ite'."""
    names = {"cci": CCI_MEANINGS, "igbp": IGBP_MEANINGS, "ite": ITE_MEANINGS}[product].split()
    values = {"cci": CCI_VALUES, "igbp": range(18), "ite": range(1, 26)}[product]
    return spark.createDataFrame(list(zip(values, names, strict=True)), "flag_value INT, flag_meaning STRING")


def decode(cells: DataFrame, product: str, code: str = "code") -> DataFrame:
    """Names for the codes of a field; unknown codes get NULL.  A legend has a few dozen rows, so it is broadcast."""
    table = legend(cells.sparkSession, product).withColumnRenamed("flag_value", code)
    return cells.join(F.broadcast(table), code, "left")
