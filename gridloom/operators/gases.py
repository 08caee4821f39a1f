"""Greenhouse-gas series and nitrogen-deposition sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.columns import cell_area, mass_mixing_ratio, year_of
from gridloom.operators.timeaxis import year_starts
from gridloom.session import small
from gridloom.sources.axes import facts

# Fixed value: first year of the scenario files, which is the last of the historical ones.
WATERSHED = 2015
# Fixed value: kg/m2/s to Gt/yr with years of 360 days.
GIGATONNES_PER_YEAR = 86400.0 * 360.0 / 1.0e12


def radiation_series(samples: DataFrame, project: str, begin: int, end: int | None = None) -> DataFrame:
    """Mass mixing ratios ``(gas, year, value)`` at the start of each year from mole fractions ``(gas, sector, days, value)``.

    Only sector 0, the global mean, counts.  Begin or end are moved to what the project covers.  Without `end` the
    value of the single year itself is returned.
    """
    if project == "scenario":
        begin = max(begin, WATERSHED)
    elif end is not None:
        end = min(end, WATERSHED)
    if end is not None and begin >= end:
        raise ValueError("the first year has to be before the last")
    s = samples.filter("sector = 0").withColumn("year", year_of(F.col("days"), project))
    s = s.withColumn("value", mass_mixing_ratio(F.col("gas"), F.col("value"))).select("gas", "year", "value")
    if end is None:
        return s.filter(F.col("year") == begin)
    return year_starts(s, ["gas"], begin, end)


def add_species(cells: DataFrame, keys: list[str], species: int = 4, value: str = "value") -> DataFrame:
    """Sum of the species per cell; only cells where all of them exist, masked if any is masked."""
    out = cells.groupBy(*keys).agg(F.sum(value).alias("_s"), F.count(F.lit(1)).alias("_n"), F.count(value).alias("_v"))
    return out.filter(F.col("_n") == species).select(*keys, F.when(F.col("_v") == species, F.col("_s")).alias(value))


def area_totals(cells: DataFrame, axis_y: DataFrame, axis_x: DataFrame, by: list[str], factor: float = 1.0, value: str = "value") -> DataFrame:
    """Area-weighted sum per group, times a unit factor."""
    ya = axis_y.select(F.col("idx").alias("y"), F.col("lo").alias("_ya"), F.col("hi").alias("_yb"))
    xa = axis_x.select(F.col("idx").alias("x"), F.col("lo").alias("_xa"), F.col("hi").alias("_xb"))
    f_y, f_x = facts(axis_y, axis_x)
    rows = cells.join(small(ya, f_y.n), "y").join(small(xa, f_x.n), "x")
    area = cell_area(F.col("_ya"), F.col("_yb"), F.col("_xa"), F.col("_xb"))
    return rows.groupBy(*by).agg((F.sum(F.col(value) * area) * F.lit(factor)).alias("total"))
