"""Land-cover classes: crosswalks between class systems, fractions per class level, ice and ocean rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.operators.regrid import area_shares
from gridloom.session import lookup, row_count, within_tasks

CELL = ["y", "x"]
OCEAN, C3_GRASS, C4_GRASS, SOIL, ICE = 0, 3, 4, 8, 9


def crosswalk_percentages(table: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Whole percentages from shares ``(source_type, target_type, share)`` given as fractions of 1 or of 100.

    Shares are rounded half to even; what a row then lacks to 100 goes to its largest entry, the first on ties.  Rows
    that sum to neither 1 nor 100 make the crosswalk invalid: `check_crosswalk` raises.
    """
    by = by or []
    row = Window.partitionBy(*by, "source_type")
    t = table.withColumn("total", F.sum("share").over(row))
    scale = F.when(F.abs(F.col("total") - 1) <= 1.1e-5, 100.0).otherwise(1.0)
    t = t.withColumn("pct", F.rint(F.col("share") * scale).cast("int"))
    order = row.orderBy(F.desc("pct"), F.asc("target_type"))
    lack = 100 - F.sum("pct").over(row)
    t = t.withColumn("_lack", lack.cast("int")).withColumn("_first", F.row_number().over(order) == 1)
    return t.select(
        *by, "source_type", "target_type", F.when(F.col("_first"), F.col("pct") + F.col("_lack")).otherwise(F.col("pct")).alias("pct"),
        "total",
    )


def check_crosswalk(percentages: DataFrame) -> None:
    """Raise unless all rows sum to 1, or all to 100."""
    near = [F.bool_and(F.abs(F.col("total") - v) <= 1e-8 + 1e-5 * v) for v in (1.0, 100.0)]
    one, hundred = percentages.agg(near[0].alias("a"), near[1].alias("b")).first()
    if not (one or hundred):
        raise ValueError("the contributions of a crosswalk row do not add up to 100 percent")


def match_flags(crosswalk: DataFrame, flags: DataFrame) -> DataFrame:
    """Crosswalk by code: names ``source_type`` meet flags ``(flag_value, flag_meaning)`` in lower case; both must match."""
    c = crosswalk.withColumn("flag_meaning", F.lower("source_type"))
    f = flags.select("flag_value", F.lower("flag_meaning").alias("flag_meaning"))
    names = c.select("flag_meaning").distinct()
    if names.join(f, "flag_meaning", "left_anti").limit(1).count() or f.join(names, "flag_meaning", "left_anti").limit(1).count():
        raise ValueError("the class names of the field and of the crosswalk differ")
    return c.join(f, "flag_meaning").select(F.col("flag_value").alias("code"), "target_type", "pct")


def fold_whole_classes(crosswalk: DataFrame) -> DataFrame:
    """Recode table ``(code, folded)``: classes that go wholly to one target share the first code that does."""
    whole = crosswalk.filter("pct = 100")
    first = F.min("code").over(Window.partitionBy("target_type"))
    return whole.select("code", first.alias("folded")).filter("code <> folded")


def recode(cells: DataFrame, table: DataFrame, code: str = "code") -> DataFrame:
    out = lookup(cells, table.select(F.col("code").alias(code), "folded"), [code], "left")
    return out.withColumn(code, F.coalesce("folded", F.col(code))).drop("folded")


def apply_crosswalk(cells: DataFrame, crosswalk: DataFrame, code: str = "code") -> DataFrame:
    """One row per cell and target class with its percentage; masked cells are masked in every class.

    Each code's targets travel as one short array, so the lookup is unique per code.
    """
    targets = crosswalk.groupBy(F.col("code").alias(code)).agg(
        F.array_sort(F.collect_list(F.struct("target_type", "pct"))).alias("_to")
    )
    empty = crosswalk.agg(F.array_sort(F.collect_set("target_type")).alias("t")).first()["t"] or []
    nothing = F.array(*[F.struct(F.lit(t).alias("target_type"), F.lit(0).alias("pct")) for t in empty])
    out = lookup(cells, targets, [code], "left").withColumn("_k", F.explode(F.coalesce("_to", nothing)))
    value = F.when(F.col(code).isNotNull(), F.col("_k.pct").cast("double"))
    return out.withColumn("pl", F.col("_k.target_type")).withColumn("value", value).drop("_k", "_to", code)


def normalise(fractions: DataFrame, by: list[str] | None = None, value: str = "value") -> DataFrame:
    """Fractions per cell clipped to 0..1 and scaled to sum 1; cells without any class stay zero, masks stay."""
    w = Window.partitionBy(*(by or []), *CELL)
    v = F.col(value)
    clipped = F.when(F.isnan(v), v).otherwise(F.least(F.greatest(v, F.lit(0.0)), F.lit(1.0)))
    out = fractions.withColumn(value, F.when(v.isNotNull(), clipped)).withColumn("_sum", F.sum(value).over(w))
    return out.withColumn(value, F.when(F.col("_sum") == 0, F.col(value)).otherwise(F.col(value) / F.col("_sum"))).drop("_sum")


def class_levels(fractions: DataFrame, levels: list[int]) -> DataFrame:
    """Rows of the given class levels; a level that does not occur raises."""
    out = fractions.filter(F.col("pl").isin(levels))
    found = {r["pl"] for r in out.select("pl").distinct().limit(len(levels)).collect()}
    if set(levels) - found:
        raise ValueError(f"class levels {sorted(set(levels) - found)} are not in the field")
    return out


def level_value(level: int, value: str = "value", by: list[str] | None = None) -> Column:
    """Value of one class level, on every row of the cell."""
    return F.max(F.when(F.col("pl") == level, F.col(value))).over(Window.partitionBy(*(by or []), *CELL))


def land_fraction(fractions: DataFrame) -> DataFrame:
    return fractions.filter(F.col("pl") == OCEAN).withColumn("value", 1 - F.col("value")).drop("pl")


def whole_fraction_ice(fractions: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Ice is all or nothing; where it goes, the other classes are scaled up.  NaN cells stay."""
    f = fractions.withColumn("_ice", level_value(ICE))
    known = ~F.isnan("_ice")
    v = F.when(known & (F.col("_ice") >= threshold), F.when(F.col("pl") == ICE, 1.0).otherwise(0.0)).when(
        known & (F.col("_ice") < threshold) & (F.col("pl") == ICE), 0.0
    ).otherwise(F.col("value"))
    masked = F.col("value").isNull()
    return normalise(f.withColumn("value", F.when(~masked, v)).drop("_ice"))


def remove_ocean(fractions: DataFrame, min_frac: float = 0.5) -> DataFrame:
    """Drop the ocean class: cells with at least 1 - min_frac ocean are masked, the others are all land.

    NaN cells stay NaN.  `land_mask` reads the land mask off the result.
    """
    f = fractions.withColumn("_sea", level_value(OCEAN))
    known = ~F.isnan("_sea")
    sea = known & (F.col("_sea") >= 1.0 - min_frac)
    v = F.when(known & ~sea & (F.col("pl") == OCEAN), 0.0).otherwise(F.col("value"))
    out = normalise(f.withColumn("_drop", F.coalesce(sea, F.lit(False))).withColumn("value", v))
    out = out.filter(F.col("pl") != OCEAN)
    return out.withColumn("value", F.when(~F.col("_drop"), F.col("value"))).drop("_sea", "_drop")


def land_mask(no_ocean: DataFrame) -> DataFrame:
    """1 where any class has a value, 0 where all are masked, masked where a value is NaN."""
    out = no_ocean.groupBy(*CELL).agg(
        F.count("value").alias("_n"), F.bool_or(F.coalesce(F.isnan("value"), F.lit(False))).alias("_nan")
    )
    return out.select(*CELL, F.when(~F.col("_nan"), (F.col("_n") > 0).cast("int")).alias("land"))


def split_grass(fractions: DataFrame, c4: DataFrame, strict: bool = True) -> DataFrame:
    """Move part of class 3 to class 4: least(c4 percentage / 100, class 3).  Any existing class 4 raises."""
    if strict and fractions.filter((F.col("pl") == C4_GRASS) & (F.col("value") > 0)).limit(1).count():
        raise ValueError("the field already has some of class 4")
    share = c4.select(*CELL, (F.col("value") / 100.0).alias("_c4"))
    dealt = within_tasks(fractions, row_count(fractions), *CELL)
    f = dealt.join(share, CELL, "left").withColumn("_c3", level_value(C3_GRASS))
    moved = F.when(F.col("_c4").isNotNull() & F.col("_c3").isNotNull(), F.least("_c4", "_c3"))
    v = F.when(F.col("pl") == C4_GRASS, moved).when(F.col("pl") == C3_GRASS, F.col("_c3") - moved).otherwise(F.col("value"))
    return f.withColumn("value", v).drop("_c4", "_c3")


def transform_classes(
    cells: DataFrame, crosswalk: DataFrame, grids: tuple | None = None, period: float | None = 360.0,
) -> DataFrame:
    """Class codes to fractions per target class, on a target grid if `grids` = (src_y, src_x, tgt_y, tgt_x) is given."""
    folds = fold_whole_classes(crosswalk)
    kept = crosswalk.join(folds.select("code"), "code", "left_anti")
    coded = recode(cells.select("y", "x", "code"), folds)
    if grids:
        # A target cell meets each code once, however many source cells have it, and only then the ten target classes.
        f = apply_crosswalk(area_shares(coded, *grids, by=["code"], period=period), kept)
        mean = F.expr("IF(bool_and(_inside), sum(value * _w) / sum(IF(value IS NOT NULL, _w, NULL)), double('NaN'))")
        f = f.groupBy("pl", "y", "x").agg(mean.alias("value"))
    else:
        f = apply_crosswalk(coded, kept)
    f = normalise(f.withColumn("value", F.col("value") / 100.0))
    if not grids and not crosswalk.filter("pct NOT IN (0, 100)").limit(1).count():
        f = f.withColumn("value", F.col("value").cast("byte"))
    return f


def polar_replacement(snow: DataFrame, snow_code: int = -36, ocean_code: int = -45) -> DataFrame:
    """Codes from an interpolated snow indicator: snow above one half, ocean elsewhere."""
    return snow.withColumn("code", F.when((F.col("value") > 0.5) & ~F.isnan("value"), snow_code).otherwise(ocean_code))


def recode_where(cells: DataFrame, other: DataFrame, test: Column, to: int, keys: list[str] | None = None, code: str = "code") -> DataFrame:
    """Set the code to `to` where `test`, on the other field's ``_other`` column, holds."""
    keys = keys or CELL
    out = cells.join(other.select(*keys, F.col(code).alias("_other")), keys, "left")
    return out.withColumn(code, F.when(test, F.lit(to)).otherwise(F.col(code))).drop("_other")


def masks_from_fraction(fraction: DataFrame, value: str = "value") -> DataFrame:
    """Land mask (any land is land) and sea mask (any sea is sea, marked 0)."""
    v = F.col(value)
    known = ~F.isnan(v)
    return fraction.withColumn("land_mask", F.when(known & (v > 0), 1).otherwise(0)).withColumn(
        "sea_mask", F.when(known & (v < 1), 0).otherwise(1)
    )
