"""Comparisons and sanity checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.columns import isclose


def compare_fields(a: DataFrame, b: DataFrame, keys: list[str], value: str = "value", rtol: float = 0.0, atol: float = 0.0, by: list[str] | None = None) -> DataFrame:
    """Counts per group: cells in both, only in one, differing, and the largest difference.

    NULL equals NULL and NaN equals NaN; values may differ within the tolerances.
    """
    return _joined(a, b, keys, value, rtol, atol).groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("cells"),
        F.count_if(F.col("_l").isNull()).alias("only_right"),
        F.count_if(F.col("_r").isNull()).alias("only_left"),
        F.count_if(F.col("_l").isNotNull() & F.col("_r").isNotNull() & ~F.col("_same")).alias("differing"),
        F.max(F.when(~F.isnan("_a") & ~F.isnan("_b"), F.abs(F.col("_a") - F.col("_b")))).alias("largest"),
    )


def _joined(a, b, keys, value, rtol, atol):
    l = a.select(*keys, F.col(value).cast("double").alias("_a"), F.lit(True).alias("_l"))
    r = b.select(*keys, F.col(value).cast("double").alias("_b"), F.lit(True).alias("_r"))
    same = F.col("_a").eqNullSafe(F.col("_b"))
    if rtol or atol:
        same = same | F.coalesce(isclose(F.col("_a"), F.col("_b"), rtol, atol), F.lit(False))
    return l.join(r, keys, "full_outer").withColumn("_same", same)


def first_differences(a: DataFrame, b: DataFrame, keys: list[str], n: int = 5, value: str = "value") -> DataFrame:
    """The first `n` differing cells in key order."""
    j = _joined(a, b, keys, value, 0.0, 0.0)
    bad = ~(F.coalesce("_l", F.lit(False)) & F.coalesce("_r", F.lit(False)) & F.col("_same"))
    return j.filter(bad).orderBy(*keys).limit(n).select(*keys, F.col("_a").alias("left"), F.col("_b").alias("right"))


def compare_attributes(a: DataFrame, b: DataFrame, ignore: tuple[str, ...] = ("history",)) -> DataFrame:
    """Attribute tables ``(field_id, name, text)`` that differ; ignored names are left out."""
    l, r = (df.filter(~F.col("name").isin(list(ignore))).select("field_id", "name", F.col("text").alias(c)) for df, c in ((a, "left"), (b, "right")))
    return l.join(r, ["field_id", "name"], "full_outer").filter(~F.col("left").eqNullSafe(F.col("right")))


def compare_series(source_wide: DataFrame, product: DataFrame, columns: list[str], factors: dict[str, float] | None = None, year: str = "year", every: int = 1) -> DataFrame:
    """Source table with a column per gas against product rows ``(year, gas, value)``; the source is scaled per gas.

    `every` keeps one product row in that many first, counted per gas in year order (a 30-day product sampled yearly).
    """
    from pyspark.sql import Window

    long = source_wide.unpivot([year], columns, "gas", "source")
    for gas, f in (factors or {}).items():
        long = long.withColumn("source", F.when(F.col("gas") == gas, F.col("source") * f).otherwise(F.col("source")))
    if every > 1:
        n = F.row_number().over(Window.partitionBy("gas").orderBy(year)) - 1
        product = product.withColumn("_n", n).filter(F.col("_n") % every == 0).drop("_n")
    j = long.join(product.select(year, "gas", F.col("value").alias("product")), [year, "gas"])
    return j.withColumn("difference", F.col("product") - F.col("source"))


def mask_problems(mask: DataFrame, value: str = "land") -> DataFrame:
    """How many cells of a mask are masked, and how many hold something else than 0 or 1."""
    v = F.col(value)
    return mask.agg(
        F.count(F.lit(1)).alias("cells"), F.count_if(v.isNull()).alias("masked"), F.count_if(v.isNotNull() & ~v.isin(0, 1)).alias("other")
    )
