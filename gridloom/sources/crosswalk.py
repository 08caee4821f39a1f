"""Class crosswalks from JSON files ``{"source": [...], "target": [...], "cover_map": [[...]]}``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.classes import check_crosswalk, crosswalk_percentages

SCHEMA = "cover_map ARRAY<ARRAY<DOUBLE>>, source ARRAY<STRING>, target ARRAY<INT>"


def from_arrays(maps: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Shares ``(source_type, target_type, share)`` from rows of the three arrays."""
    row = maps.select(*(by or []), "source", "target", F.posexplode("cover_map").alias("_i", "_row"))
    cell = row.select(
        *(by or []), F.element_at("source", F.col("_i") + 1).alias("source_type"), "target", F.posexplode("_row").alias("_j", "share")
    )
    return cell.select(*(by or []), F.lower("source_type").alias("source_type"), F.element_at("target", F.col("_j") + 1).alias("target_type"), "share")


def load_crosswalk(spark: SparkSession, path: str) -> DataFrame:
    """Whole percentages ``(source_type, target_type, pct)``; the shape and the row sums are checked."""
    raw = spark.read.schema(SCHEMA).option("multiLine", True).json(path)
    bad = (F.size("cover_map") != F.size("source")) | F.exists("cover_map", lambda r: F.size(r) != F.size("target"))
    if raw.filter(bad).limit(1).count():
        raise ValueError("the cover map has another shape than its source and target lists")
    pct = crosswalk_percentages(from_arrays(raw))
    check_crosswalk(pct)
    return pct.drop("total")
