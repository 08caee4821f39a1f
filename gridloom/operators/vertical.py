"""Vertical regridding per column.  Target levels are few and travel inside the row, so no join is needed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.columns import nan
from gridloom.session import small


def _level_array(targets) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("idx"), F.lit(float(z)).alias("z")) for i, z in enumerate(targets)])


def relevel(
    cells: DataFrame, targets: list[float] | str, column: list[str], z: str = "height", value: str = "value",
    method: str = "linear", extrapolation: str = "nearest",
) -> DataFrame:
    """Values at target heights, per column; source heights may differ from column to column.

    `targets` is a list of heights, or the name of a column holding the array ``(idx, z)`` of the cell's own column.
    `method` linear or nearest (the lower level half way), `extrapolation` nearest, linear or nan.  A masked level masks
    what is interpolated from it.
    """
    if method not in ("linear", "nearest") or extrapolation not in ("nearest", "linear", "nan"):
        raise ValueError("unknown method or extrapolation")
    w = Window.partitionBy(*column).orderBy(z)
    seg = cells.withColumn("_z1", F.lead(z).over(w)).withColumn("_v1", F.lead(value).over(w))
    seg = seg.withColumn("_zp", F.lag(z).over(w)).withColumn("_vp", F.lag(value).over(w))
    array = F.col(targets) if isinstance(targets, str) else _level_array(targets)
    low, high, prev = F.col(z), F.col("_z1"), F.col("_zp")

    def mine(t):
        above = (t["z"] >= low) & (high.isNull() | (t["z"] < high))
        return above | (prev.isNull() & (t["z"] < low))

    seg = seg.withColumn("_t", F.explode(F.filter(array, mine)))
    t = F.col("_t.z")
    v, v1, vp = F.col(value), F.col("_v1"), F.col("_vp")
    if method == "linear":
        inner = F.when(t == low, v).otherwise(v + (t - low) / (high - low) * (v1 - v))
    else:
        inner = F.when(t - low <= high - t, v).otherwise(v1)
    if extrapolation == "nan":
        below = above = nan()
    elif extrapolation == "nearest":
        below = above = v
    else:
        below = v + (t - low) / (high - low) * (v1 - v)
        above = F.when(prev.isNull(), v).otherwise(vp + (t - prev) / (low - prev) * (v - vp))
    top = high.isNull() & (t > low)
    res = F.when(prev.isNull() & (t < low), below).when(top, above).when(t == low, v).otherwise(inner)
    return seg.select(*column, F.col("_t.idx").alias("level"), t.alias("z"), res.alias(value))


def relevel_conservative(
    cells: DataFrame, bounds: list[tuple[float, float]], column: list[str], lo: str = "z_lo", hi: str = "z_hi", value: str = "value",
) -> DataFrame:
    """Means over target layers, weighted by the thickness shared with each source layer.

    Layers over no source layer have no row; masked source layers do not count.
    """
    layers = F.array(*[
        F.struct(F.lit(i).alias("idx"), F.lit(float(a)).alias("a"), F.lit(float(b)).alias("b")) for i, (a, b) in enumerate(bounds)
    ])
    hit = F.filter(layers, lambda t: (t["b"] > F.col(lo)) & (t["a"] < F.col(hi)))
    rows = cells.withColumn("_t", F.explode(hit))
    share = F.least(F.col("_t.b"), F.col(hi)) - F.greatest(F.col("_t.a"), F.col(lo))
    return rows.groupBy(*column, F.col("_t.idx").alias("level")).agg(
        (F.sum(F.col(value) * share) / F.sum(F.when(F.col(value).isNotNull(), share))).alias(value)
    )


def hybrid_height(cells: DataFrame, levels: DataFrame, orography: DataFrame) -> DataFrame:
    """Altitude of each cell: level height + sigma * surface altitude; refuses pressure-based levels."""
    if "level_pressure" in levels.columns:
        raise ValueError("pressure levels are not supported")
    out = cells.join(small(levels), "level").join(orography, ["y", "x"])
    return out.withColumn("altitude", F.col("height") + F.col("sigma") * F.col("surface_altitude"))
