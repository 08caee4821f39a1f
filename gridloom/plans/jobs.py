"""End-to-end preparation jobs, composed of the operators.  Each takes and returns DataFrames; sinks are in `sinks`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators import classes as cl
from gridloom.operators import fill, gases, merge, regions, regrid, rivers, stencil, timeaxis, vertical
from gridloom.functions.columns import clip_negative
from gridloom.functions.legends import legend
from gridloom.session import materialise, row_count, within_tasks
from gridloom.sinks import writers
from gridloom.sources import axes as ax
from gridloom.sources import fields as fl

Axes = tuple[DataFrame, DataFrame]

# Fixed value: direction code of an outflow to the ocean.
POUR_POINT = 9


def general_regrid(
    cells: DataFrame, source: Axes, target: Axes, by: list[str] | None = None, years: tuple[int, int] | None = None,
    mask: DataFrame | None = None, invert: bool = False, heights: list[float] | None = None, period: float | None = 360.0,
) -> DataFrame:
    """Optional year filter, optional vertical regrid, area-weighted regrid, optional fill against a mask."""
    by = by or []
    if years:
        cells = timeaxis.year_range(cells, *years)
    if heights:
        column = [c for c in by if c != "z"] + ["y", "x"]
        cells = vertical.relevel(cells, heights, column).drop("z").withColumnRenamed("level", "z")
    out = regrid.two_stage(cells, *source, *target, by=by, period=period)
    if mask is not None:
        ny, nx = (f.n for f in ax.facts(*target))
        out = materialise(regrid.complete(out, ny, nx, by))
        out = fill.make_consistent(out, mask, *target, invert=invert, circular=bool(period), by=by)
    return out


def fill_and_merge(
    primary: DataFrame, alternate: DataFrame, grid: Axes, outline: DataFrame | None = None, mask: DataFrame | None = None,
    other: list[str] | None = None, invert: bool = False, circular: bool = True,
) -> DataFrame:
    """Merge two sources on the grid's cells, the primary valid inside the outline, then fill against a mask.

    Fields are ``(other..., y, x, value)`` on the same grid; the primary may cover a part of it only.
    """
    other = other or []
    y, x = grid
    p = primary if outline is None else merge.inside_polygons(primary, outline, y, x)
    out = merge.merge(p, alternate, other, None if outline is None else "inside", place=("y", "x"), exact=True)
    if mask is not None:
        out = fill.make_consistent(materialise(out), mask, y, x, invert=invert, circular=circular, by=other)
    return out


def land_cover(
    codes: DataFrame, source: Axes, target: Axes, crosswalk: DataFrame, min_frac: float = 0.5, mask: DataFrame | None = None,
    period: float | None = 360.0,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Class fractions without ocean, land mask and land fraction on a target grid.

    The ice rules run before the ocean class goes.  With a given mask no land is removed and the fractions are filled to it.
    """
    ny, nx = (f.n for f in ax.facts(*target))
    f = cl.transform_classes(codes, crosswalk, (*source, *target), period)
    f = materialise(f.withColumn("value", F.coalesce("value", F.lit(float("nan")))))
    land_fraction = cl.land_fraction(f)
    f = cl.whole_fraction_ice(f)
    f = regions.keep_glacial_ice(materialise(regrid.complete(f, ny, nx, ["pl"])), nx, wrap=bool(period))
    f = cl.remove_ocean(f, 0.0 if mask is not None else min_frac)
    f = materialise(f)
    land = cl.land_mask(f)
    if mask is not None:
        f = fill.make_consistent(f, mask, *target, invert=True, circular=bool(period), by=["pl"])
    return f, land, land_fraction


def c4_injection(fractions: DataFrame, c4: DataFrame, c4_axes: Axes, target: Axes, period: float | None = 360.0) -> DataFrame:
    """Bring a class-4 percentage to the fractions' grid, fill it to their land, and split class 3 by it."""
    ny, nx = (f.n for f in ax.facts(*target))
    on_grid = regrid.complete(regrid.area_weighted(c4, *c4_axes, *target, period=period), ny, nx)
    dealt = within_tasks(fractions, row_count(fractions), "y", "x")
    sea = dealt.groupBy("y", "x").agg((F.count("value") == 0).alias("masked"))
    filled = fill.fill_missing(on_grid, *target, circular=bool(period), target_mask=sea)
    return cl.split_grass(fractions, filled)


def prepare_fine_classes(
    codes: DataFrame, grid: Axes, polar: DataFrame, polar_axes: Axes, lakes: DataFrame, ocean_lakes: DataFrame,
    limit: float = -60.0, snow_class: int = 15, water: int = -46, lake: int = -47, ocean: int = -45,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fine class field with class names, and its axes with their outer bounds on the poles and on the date line.

    The polar cap comes from a second source, gaps are filled, named lakes are marked as ocean or as resolved lakes.
    """
    y, x = grid
    south_first = ax.facts(y)[0].first == 0
    y = ax.set_outer_bounds(y, *((-90.0, 90.0) if south_first else (90.0, -90.0)))
    x = ax.set_outer_bounds(x, -180.0, 180.0)
    nx = ax.facts(x)[0].n
    cap = y.filter(F.col("point") < limit)
    snow = polar.select("y", "x", (F.col("code") == snow_class).cast("double").alias("value"))
    snow = regrid.bilinear(snow, *polar_axes, cap, x, mode="linear", period=360.0)
    out = merge.overwrite(codes.select("y", "x", "code"), cl.polar_replacement(snow), ["y", "x"], "code")
    as_value = out.select("y", "x", F.col("code").cast("double").alias("value"))
    out = fill.fill_missing(as_value, y, x).select("y", "x", F.col("value").cast("int").alias("code"))
    out = materialise(out)
    out = regions.fill_lakes(out, ocean_lakes, y, x, nx, [water], ocean)
    out = regions.fill_lakes(materialise(out), lakes, y, x, nx, [water], lake)
    names = legend(out.sparkSession, "cci").withColumnRenamed("flag_value", "code")
    return out.join(F.broadcast(names), "code", "left"), y, x


def prepare_coarse_classes(codes: DataFrame, climate_classes: DataFrame, grid: Axes, ocean_class: int = 15) -> DataFrame:
    """Coarse class field: inland and ocean water told apart by a second source, gaps filled, names attached."""
    out = cl.recode_where(codes, climate_classes, F.col("_other") == ocean_class, 0)
    v = out.select("y", "x", F.col("code").cast("double").alias("value"))
    out = fill.fill_missing(v, *grid).select("y", "x", F.col("value").cast("int").alias("code"))
    names = legend(codes.sparkSession, "igbp").withColumnRenamed("flag_value", "code")
    return out.join(F.broadcast(names), "code", "left")


def prepare_national_classes(parts: list[DataFrame]) -> DataFrame:
    """National class field from its tiles, with names."""
    out = merge.concatenate(parts, ["y", "x"])
    names = legend(out.sparkSession, "ite").withColumnRenamed("flag_value", "code")
    return out.join(F.broadcast(names), "code", "left")


def masks(land_fraction: DataFrame) -> DataFrame:
    """Land and sea masks, masked cells as -1."""
    out = cl.masks_from_fraction(land_fraction)
    for c in ("land_mask", "sea_mask"):
        out = out.withColumn(c, F.when(F.col("value").isNull(), -1).otherwise(F.col(c)))
    return out.drop("value")


def add_lakes(land: DataFrame, land_axes: Axes, codes: DataFrame, code_axes: Axes, lake: int, period: float | None = 360.0) -> DataFrame:
    """Mask cells whose nearest class cell is a resolved lake become water."""
    near = regrid.nearest(codes, *code_axes, *land_axes, period=period)
    flagged = land.select("y", "x", F.col("land").alias("code"))
    return cl.recode_where(flagged, near, F.col("_other") == lake, 0).withColumnRenamed("code", "land")


def fix_edge_rows(cells: DataFrame, ny: int, value: str = "value") -> DataFrame:
    """NaN on the first row becomes 0 (sea), on the last row 1 (land)."""
    v = F.col(value)
    lost = F.isnan(v)
    return cells.withColumn(value, F.when(lost & (F.col("y") == 0), 0.0).when(lost & (F.col("y") == ny - 1), 1.0).otherwise(v))


def river_routing(
    directions: DataFrame, land_fraction: DataFrame, source: Axes, target: Axes, threshold: float = 0.0, period: float | None = 360.0,
) -> DataFrame:
    """Direction and sequence with pour points where land ends, masked where all is sea and nothing flows in.

    `directions` ``(y, x, code, sequence)`` is on the target grid, the land fraction on the source grid.
    """
    ny, nx = (f.n for f in ax.facts(*target))
    lcf = fix_edge_rows(regrid.area_weighted(land_fraction, *source, *target, period=period), ny)
    d = directions.join(lcf.select("y", "x", F.col("value").alias("_lcf")), ["y", "x"], "left")
    known = ~F.isnan("_lcf")
    d = d.withColumn("code", F.when(known & (F.col("_lcf") <= threshold), POUR_POINT).otherwise(F.col("code")))
    d = stencil.flow_in(d, ny, nx)
    mask = F.coalesce(F.col("_lcf") == 0, F.lit(False)) & ~F.col("flow_in")
    return d.select("y", "x", F.when(~mask, F.col("code")).alias("code"), F.when(~mask, F.col("sequence")).alias("sequence"))


def river_numbers(
    runoff: DataFrame, ocean: DataFrame, sea: DataFrame, mouths: DataFrame, ny: int, nx: int, scaling: float,
    max_rivers: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Numbered ocean table ``(y, x, nav_lat, nav_lon, river)`` and mouths ``(id, river)`` without unused numbers.

    Without runoff, pass an empty table: every ocean cell then starts without a number.
    """
    valid = rivers.valid_runoff(runoff, ny, nx, sea)
    found = rivers.number_rivers(rivers.runoff_regions(valid, ny, nx), max_rivers)
    numbered = materialise(found.select("y", "x", "river"))
    linked, extra = rivers.link_mouths(mouths, ocean, sea, numbered, scaling, ny, nx)
    table = writers.ocean_river_table(numbered.unionByName(extra), ocean)
    ocean_out, land_out = rivers.close_gaps(materialise(table), materialise(linked))
    return ocean_out, land_out


def river_storage(storage: DataFrame, source: Axes, target: Axes, directions: DataFrame, by: list[str], period: float | None = 360.0) -> DataFrame:
    """Storage on the routing grid, masked where the direction is."""
    out = regrid.area_weighted(storage, *source, *target, by=by, period=period)
    mask = directions.select("y", "x", F.col("code").cast("double").alias("value"))
    return merge.mask_by(out, mask, ["y", "x"])


def prepare_river_records(records: DataFrame, by: list[str], section: int, item: int, storage: bool) -> DataFrame:
    """Records of one item with corrected times, merged into fields."""
    r = fl.select_records(records, section, item)
    r = timeaxis.as_monthly_means(r) if storage else timeaxis.thirtieth(r)
    return fl.merge_records(r, by, ["yr", "mon", "dat"])


def topographic_index(index: DataFrame, source: Axes, target: Axes, fractions: DataFrame, period: float | None = 360.0) -> DataFrame:
    """Mean and deviation of the index, both filled by one mapping, zero on ice, masked where the class field is."""
    ny, nx = (f.n for f in ax.facts(*target))
    both = regrid.area_weighted(index, *source, *target, period=period, stdev=True)
    both = materialise(regrid.complete(both.withColumn("_b", F.struct("value", "stdev")), ny, nx, None, "_b").select("y", "x", "_b.*"))
    ice = fractions.filter(F.col("pl") == cl.ICE).select(
        "y", "x", (F.col("value") > 0).alias("ice"), F.col("value").isNull().alias("gone")
    )
    flags = materialise(ice.select("y", "x", "gone", F.coalesce("ice", F.lit(False)).alias("ice")))
    mapping = fill.nearest_valid(
        both.join(flags, ["y", "x"], "left"), *target, circular=bool(period),
        wanted=~F.coalesce(F.col("ice") | F.col("gone"), F.lit(False)),
    )
    out = fill.apply_mapping(fill.apply_mapping(both, mapping), mapping, value="stdev").join(flags, ["y", "x"], "left")
    for c in ("value", "stdev"):
        out = out.withColumn(c, F.when(F.col("ice"), 0.0).when(~F.coalesce("gone", F.lit(False)), F.col(c)))
    return out.drop("ice", "gone")


def prepare_topographic_index(cells: DataFrame, grid: Axes, missing: float = -1.0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Index with its sentinel masked, and axes stretched to the globe's edges."""
    y = ax.set_outer_bounds(ax.guess_bounds(grid[0], latitude=True), -90.0, 90.0)
    x = ax.guess_bounds(grid[1])
    last = ax.facts(grid[1])[0].n - 1
    x = x.withColumn("hi", F.when(F.col("idx") == last, 180.0).otherwise(F.col("hi")))
    return cells.withColumn("value", F.nullif("value", F.lit(missing))), y, x


def convert_records(records: DataFrame, by: list[str], time: list[str], level: str = "lev") -> DataFrame:
    """Records with non-negative processing codes in file order."""
    return writers.record_order(fl.non_negative_proc(records), by, time, level)


def radiation_listing(samples: DataFrame, project: str, begin: int, end: int | None, unused: list[str] | None = None) -> DataFrame:
    """Configuration lines of the radiation gases."""
    return writers.series_listing(materialise(gases.radiation_series(samples, project, begin, end)), unused)


def chemistry_table(samples: DataFrame, begin: int, end: int, columns: list[str] | None = None, by: list[str] | None = None) -> DataFrame:
    """One row per year with all gas columns, from samples ``(gas, sector, year, value)`` of sector 0."""
    return writers.wide_table(samples.filter("sector = 0").filter(F.col("year").between(begin, end)), columns, by)


def nitrogen_deposition(
    species: DataFrame, source: Axes, target: Axes, begin: int | None = None, end: int | None = None, climatology: bool = False,
    pad: tuple[int, int] | None = None, repeat_last: int = 1, n_species: int = 4,
) -> DataFrame:
    """Sum of four species per month on the target grid, never negative.

    `species` ``(field_id, year, month, y, x, value)``.  `pad` names the years copied to the first and to the last year.
    """
    s = species.withColumn("_t", F.col("year") * 12 + F.col("month"))
    s = timeaxis.split_climatologies(s, climatology, t="_t").drop("_t")
    total = gases.add_species(s, ["year", "month", "y", "x"], n_species)
    keys = ["year", "month"]
    if not climatology and begin is not None:
        total = timeaxis.year_range(total, begin, end)
        if pad:
            total = timeaxis.pad_ends(total, [], begin, end, *pad, repeat_last=repeat_last)
            keys.append("days")
    out = regrid.area_weighted(total, *source, *target, by=keys)
    return out.withColumn("value", clip_negative(F.col("value")))
