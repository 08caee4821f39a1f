"""Reading fields: long-form tables, masks, target grids, record headers, gas series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.functions.columns import isclose
from gridloom.operators.regrid import same_grid
from gridloom.session import attach, lookup, small
from gridloom.sources.axes import facts, grid_cells


def load_fields(spark: SparkSession, paths: list[str] | str, names: list[str] | None = None) -> DataFrame:
    """All fields of one or more Parquet files; `names` is pushed down to the scan."""
    out = spark.read.parquet(*([paths] if isinstance(paths, str) else paths))
    drop = [c for c in out.columns if c.startswith("forecast_")]
    out = out.drop(*drop)
    return out.filter(F.col("name").isin(names)) if names else out


def with_circular_flag(axes: DataFrame, by: list[str], period: float = 360.0) -> DataFrame:
    """Axis rows with a flag telling whether their axis closes around the globe."""
    span = (F.max(F.greatest("lo", "hi")) - F.min(F.least("lo", "hi"))).alias("_span")
    return attach(axes, by, span).withColumn("circular", isclose(F.col("_span"), F.lit(period))).drop("_span")


def land_mask(fields: DataFrame, threshold: float | None = None) -> DataFrame:
    """Land/sea mask ``(y, x, land)`` with fallbacks.

    A field named land_binary_mask is taken as it is; else vegetation_area_fraction above the threshold; else the first
    field's first slice, land where it is not masked.
    """
    names = {r["name"] for r in fields.filter(F.col("name").isin("land_binary_mask", "vegetation_area_fraction")).select("name").distinct().limit(2).collect()}
    if "land_binary_mask" in names:
        return fields.filter("name = 'land_binary_mask'").select("y", "x", (F.col("value") != 0).alias("land"))
    if threshold is not None and "vegetation_area_fraction" in names:
        hit = F.max(F.when(F.col("value") > threshold, 1).otherwise(0)) == 1
        return fields.filter("name = 'vegetation_area_fraction'").groupBy("y", "x").agg(hit.alias("land"))
    dims = [c for c in ("t", "z", "pl") if c in fields.columns]
    key = fields.select("name", *dims).orderBy("name", *dims).first()
    first = fields
    for c in ("name", *dims):
        first = first.filter(F.col(c).eqNullSafe(F.lit(key[c])))
    return first.select("y", "x", F.col("value").isNotNull().alias("land"))


def load_grid(
    y: DataFrame, x: DataFrame, levels: DataFrame | None = None, orography: DataFrame | None = None,
    others: Sequence[tuple[DataFrame | None, DataFrame | None]] = (),
) -> DataFrame:
    """Target cells from separate horizontal, vertical and surface parts; altitude = height + sigma * orography.

    `others` are the axes ``(y, x)`` that further parts bring along, None where a part has none; one that differs from the grid's
    own raises.  The levels ``(level, height, sigma)`` are one axis and meet every cell as a single array.
    """
    for name, own, theirs in [(n, o, t) for pair in others for n, o, t in (("latitude", y, pair[0]), ("longitude", x, pair[1])) if t is not None]:
        if not same_grid(own, theirs, ["idx"]).first()["equal"]:
            raise ValueError(f"the parts do not make a single grid: {name} differs")
    out = grid_cells(y, x, facts(x)[0].n)
    if levels is not None:
        column = levels.agg(F.array_sort(F.collect_list(F.struct("level", "height", "sigma"))).alias("_l")).withColumn("_one", F.lit(1))
        out = out.withColumn("_one", F.lit(1)).join(small(column, at_most=1), "_one").withColumn("_l", F.explode("_l")).select("*", "_l.*").drop("_l", "_one")
    if orography is not None:
        out = out.join(orography.select("y", "x", "surface_altitude"), ["y", "x"], "left")
        if levels is not None:
            out = out.withColumn("altitude", F.col("height") + F.col("sigma") * F.col("surface_altitude"))
    return out


def select_records(records: DataFrame, section: int, item: int, model: int = 1, exactly: int | None = None) -> DataFrame:
    """Record headers of one item code; model 0 matches any.  `exactly` makes another number of records an error."""
    out = records.filter((F.col("stash") == section * 1000 + item) & F.col("model").isin(model, 0))
    if exactly is not None:
        found = out.limit(exactly + 1).count()
        if found != exactly:
            raise ValueError(f"expected {exactly} record(s), found {'more' if found > exactly else found}")
    return out


def merge_records(records: DataFrame, by: list[str], time: list[str], level: str | None = None) -> DataFrame:
    """Two-dimensional records as slices of fields: dimension numbers `t` (and `z`) per item code from ordered values.

    Only the distinct times and levels of a field are ordered; the records look their numbers up.
    """
    out = records
    for name, cols in (("t", time), ("z", [level] if level else [])):
        if cols:
            key = [*by, "stash"]
            values = records.select(*key, *cols).distinct()
            number = F.row_number().over(Window.partitionBy(*key).orderBy(*cols)) - 1
            out = lookup(out, values.withColumn(name, number), [*key, *cols])
    return out.select(*records.columns, "t", *(["z"] if level else []))


def level_order(records: DataFrame, by: list[str], level: str = "pl", seq: str = "seq") -> DataFrame:
    """Order of class levels as first met in each file."""
    first = records.groupBy(*by, level).agg(F.min(seq).alias("_first"))
    return first.withColumn("order", F.dense_rank().over(Window.partitionBy(*by).orderBy("_first")) - 1).drop("_first")


def gas_samples(spark: SparkSession, paths: dict[str, str], first_year: int = 0, days_per_year: float = 365.24, sector: int = 0) -> DataFrame:
    """Samples ``(gas, year, value)`` of one sector from one Parquet path per gas with ``(sector, days, value)``."""
    out = None
    for gas, path in paths.items():
        one = spark.read.parquet(path).filter(F.col("sector") == sector).select(
            F.lit(gas).alias("gas"), (F.col("days") / days_per_year + first_year).alias("year"), "value"
        )
        out = one if out is None else out.unionByName(one)
    return out


def mask_from_missing(records: DataFrame, cells: DataFrame, key: str = "seq", strict: bool = True) -> DataFrame:
    """Mask ``(y, x, masked)`` from the missing cells of the single field in a file whose processing code is ignored."""
    if strict and records.withColumn("proc", F.lit(0)).select("stash", "proc").distinct().limit(2).count() != 1:
        raise ValueError("expected exactly one field")
    return cells.join(records.select(key), key, "left_semi").select(key, "y", "x", F.col("value").isNull().alias("masked"))


def non_negative_proc(records: DataFrame) -> DataFrame:
    """A negative processing code means none was set: 0."""
    return records.withColumn("proc", F.greatest("proc", F.lit(0)))
