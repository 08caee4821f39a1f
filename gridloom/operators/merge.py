"""Merging overlapping sources, polygon masks, overwriting, concatenating, pairing fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.columns import TOLERANCE, tolerant_bin
from gridloom.session import discard, lookup, materialise, row_count, small
from gridloom.sources.axes import facts, overlapping_indices


def polygon_edges(vertices: DataFrame, poly: str = "poly") -> DataFrame:
    """Closed outlines ``(poly, seq, px, py)`` as edges ``(poly, x1, y1, x2, y2)``."""
    w = Window.partitionBy(poly).orderBy("seq")
    whole = Window.partitionBy(poly)
    nxt = [F.coalesce(F.lead(c).over(w), F.min_by(c, "seq").over(whole)) for c in ("px", "py")]
    e = vertices.select(poly, F.col("px").alias("x1"), F.col("py").alias("y1"), nxt[0].alias("x2"), nxt[1].alias("y2"))
    return e.filter((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))


def inside_polygons(
    cells: DataFrame, edges: DataFrame, axis_y: DataFrame, axis_x: DataFrame, corners: bool = True, poly: str = "poly",
) -> DataFrame:
    """Add `inside`: is any corner (or the centre) of the cell strictly inside any polygon?

    Outlines are intersected once with each grid line.  Between every second pair of crossings a line runs inside; the corners on such
    stretches, without those the outline touches, mark their cells.  Stretches and corners meet in bins of the axis.
    """
    f_y, f_x = facts(axis_y, axis_x)
    tall, wide = (max((f.hi - f.lo) / f.n, 1e-12) for f in (f_y, f_x))
    places = F.array("lo", "hi") if corners else F.array("point")
    lines = axis_y.select(F.col("idx").alias("y"), F.explode(places).alias("py")).withColumn("bin", F.floor(F.col("py") / tall))
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    e = edges.withColumn("bin", F.explode(F.sequence(F.floor(low / tall), F.floor(high / tall))))
    level = F.col("y1") == F.col("y2")
    at = F.col("x1") + (F.col("py") - F.col("y1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0.0)) * (F.col("x2") - F.col("x1"))
    met = e.join(small(lines, at_most=2 * f_y.n), "bin").filter(F.col("py").between(low, high))
    met = materialise(met.select(
        "y", "py", poly, ((F.col("y1") > F.col("py")) != (F.col("y2") > F.col("py"))).alias("crosses"), at.alias("at"),
        F.when(level, F.least("x1", "x2")).otherwise(at).alias("a"), F.when(level, F.greatest("x1", "x2")).otherwise(at).alias("b"),
    ))
    along = Window.partitionBy("y", "py", poly).orderBy("at")
    crossing = met.filter("crosses").select("y", "py", poly, F.col("at").alias("a"), F.lead("at").over(along).alias("b"), F.row_number().over(along).alias("_n"))
    columns = axis_x.select(F.col("idx").alias("x"), F.explode(places).alias("px")).withColumn("bin", F.floor(F.col("px") / wide))
    columns = small(columns, at_most=2 * f_x.n)
    # A stretch beyond the axis marks nothing there, so it is cut to the axis first.
    bins = F.sequence(F.floor(F.greatest("a", F.lit(f_x.lo)) / wide), F.floor(F.least("b", F.lit(f_x.hi)) / wide))

    def marked(stretches: DataFrame) -> DataFrame:
        on_axis = stretches.filter((F.col("a") <= f_x.hi) & (F.col("b") >= f_x.lo))
        return on_axis.withColumn("bin", F.explode(bins)).join(columns, "bin")

    within = marked(crossing.filter("_n % 2 = 1 AND b IS NOT NULL")).filter("px > a AND px < b").select("y", "py", poly, "x", "px")
    touched = marked(met).filter("px >= a AND px <= b").select("y", "py", poly, "x", "px")
    hit = within.join(touched, ["y", "py", poly, "x", "px"], "left_anti").select("y", "x").distinct().withColumn("inside", F.lit(True))
    return cells.join(hit, ["y", "x"], "left").withColumn("inside", F.coalesce("inside", F.lit(False)))


def compatible(a: DataFrame, b: DataFrame, keys: tuple[str, ...] = ("stash", "units", "standard_name")) -> DataFrame:
    """Pairs of catalogue rows ``(field_id, stash, units, standard_name)`` with a flag per attribute and overall."""
    l, r = a.alias("l"), b.alias("r")
    j = l.join(r, F.col("l.field_id") == F.col("r.field_id"))
    same = [F.col("l." + k).eqNullSafe(F.col("r." + k)).alias("same_" + k) for k in keys]
    out = j.select(F.col("l.field_id").alias("field_id"), *same)
    every = F.lit(True)
    for k in keys:
        every = every & F.col("same_" + k)
    return out.withColumn("compatible", every)


def common_places(frames: list[DataFrame], columns: tuple[str, ...], tol: float = TOLERANCE, digits: int = 10) -> DataFrame:
    """``(axis, bin, at)``: the coordinate that each occupied bin of each axis stands for in all `frames`.

    Sorted coordinates belong together while their gaps stay within the tolerance, across bins as well, and stand at the least of them, rounded.
    Bins are aggregated where the rows are; only those next to each other are compared, and chains of them are followed by pointer jumping.
    """
    every = None
    for df in frames:
        part = df.select(F.posexplode(F.array(*columns)).alias("axis", "v")).filter("v IS NOT NULL")
        every = part if every is None else every.unionByName(part)
    bins = every.groupBy("axis", tolerant_bin(F.col("v"), tol).alias("bin")).agg(F.min("v").alias("low"), F.max("v").alias("high"))
    bins = materialise(bins)
    before = bins.select("axis", (F.col("bin") + 1).alias("bin"), F.col("high").alias("_high"))
    linked = materialise(bins.join(before, ["axis", "bin"]).filter(F.col("low") - F.col("_high") <= F.lit(tol)).select("axis", "bin", (F.col("bin") - 1).alias("to")))
    out = bins.select("axis", "bin", F.col("bin").alias("to"))
    if row_count(linked):
        moved = True
        while moved:
            # Bins that are not linked to one before stand for themselves.
            onward = linked.select("axis", F.col("bin").alias("to"), F.col("to").alias("_next"))
            jumped = lookup(linked.select("axis", "bin", "to"), onward, ["axis", "to"], "left", at_most=row_count(linked))
            jumped = materialise(jumped.select("axis", "bin", F.coalesce("_next", "to").alias("to"), F.col("_next").isNotNull().alias("moved")))
            moved = jumped.filter("moved").limit(1).count()
            discard(linked)
            linked = jumped
        linked = linked.drop("moved")
        out = out.drop("to").join(linked, ["axis", "bin"], "left").select("axis", "bin", F.coalesce("to", "bin").alias("to"))
    start = bins.select("axis", F.col("bin").alias("to"), (F.round("low", digits) + F.lit(0.0)).alias("at"))
    return out.join(start, ["axis", "to"]).select("axis", "bin", "at")


def placed(df: DataFrame, places: DataFrame, columns: tuple[str, ...], at_most: int, tol: float = TOLERANCE) -> DataFrame:
    """`df` with its coordinates moved to those of `common_places`; nulls stay."""
    order = df.columns
    for k, c in enumerate(columns):
        own = places.filter(F.col("axis") == k).select(F.col("bin").alias("_bin"), F.col("at").alias("_at"))
        df = lookup(df.withColumn("_bin", tolerant_bin(F.col(c), tol)), own, ["_bin"], "left", at_most=at_most).withColumn(c, F.col("_at")).drop("_bin", "_at")
    return df.select(*order)


def within_tolerance(df: DataFrame, column: str, known: DataFrame, value: str, flag: str = "hit", tol: float = TOLERANCE) -> DataFrame:
    """Add `flag`: does a value of `known` lie within the tolerance?  Each bin's least and greatest value answer for the bins around it."""
    bins = known.filter(F.col(value).isNotNull()).groupBy(tolerant_bin(F.col(value), tol).alias("bin")).agg(F.min(value).alias("low"), F.max(value).alias("high"))
    # A bin's own values are all near; of a neighbour, only the nearest can be.
    around = bins.select(F.explode(F.array(*[F.struct((F.col("bin") + d).alias("_bin"), F.lit(d).alias("d"), "low", "high") for d in (-1, 0, 1)])).alias("n")).select("n.*")
    near = around.groupBy("_bin").agg(
        F.max(F.when(F.col("d") == 0, True)).alias("_own"), F.max(F.when(F.col("d") == 1, F.col("high"))).alias("_below"), F.min(F.when(F.col("d") == -1, F.col("low"))).alias("_above"))
    out = lookup(df.withColumn("_bin", tolerant_bin(F.col(column), tol)), materialise(near), ["_bin"], "left")
    a = F.col(column)
    hit = F.coalesce("_own", F.lit(False)) | F.coalesce(a - F.col("_below") <= F.lit(tol), F.lit(False)) | F.coalesce(F.col("_above") - a <= F.lit(tol), F.lit(False))
    return out.withColumn(flag, hit).drop("_bin", "_own", "_below", "_above")


def merge(
    primary: DataFrame, alternate: DataFrame, other: list[str] | None = None, valid: str | None = None, value: str = "value",
    strict: bool = True, place: tuple[str, str] = ("lat", "lon"), exact: bool = False,
) -> DataFrame:
    """Union of two fields ``(other..., lat, lon, value)`` on one coordinate system; the primary wins where it is valid.

    Places are coordinates that meet within the tolerance (`common_places`) or, with `exact`, the cell numbers of one grid.

    A masked primary cell inside stays masked, a NaN one gives way.  Outside (`valid` false) the alternate wins where it
    has a cell.  `strict` raises if NaN remains, because then the sources do not cover the domain.
    """
    keys = (other or []) + ["_a", "_b"]
    if not exact:
        places = materialise(common_places([primary, alternate], place))
        primary, alternate = (placed(df, places, place, row_count(places)) for df in (primary, alternate))

    def keyed(df, prefix, extra=()):
        return df.select(
            *(other or []), F.col(place[0]).alias("_a"), F.col(place[1]).alias("_b"), F.col(value).alias(prefix + "_v"), F.lit(True).alias(prefix + "_here"), *extra,
        )

    flag = F.coalesce(F.col(valid), F.lit(False)) if valid else F.lit(True)
    p = keyed(primary, "p", [flag.alias("p_ok")])
    j = p.join(keyed(alternate, "a"), keys, "full_outer")
    keep = F.coalesce(F.col("p_here") & F.col("p_ok") & ~F.coalesce(F.isnan("p_v"), F.lit(False)), F.lit(False))
    merged = F.when(keep, F.col("p_v")).when(F.col("a_here"), F.col("a_v")).otherwise(F.col("p_v"))
    out = j.select(*(other or []), F.col("_a").alias(place[0]), F.col("_b").alias(place[1]), merged.alias(value))
    if strict and out.filter(F.isnan(value)).limit(1).count():
        raise ValueError("the sources do not cover the whole domain")
    return out


def pair_fields(primary: DataFrame, alternate: DataFrame, strict: bool = True) -> DataFrame:
    """Pair catalogue rows ``(field_id, stash, name)`` by stash, else by name; missing or double partners raise."""
    key = F.coalesce(F.col("stash").cast("string"), F.col("name"))
    p = primary.select(F.col("field_id").alias("primary_id"), key.alias("_key"))
    a = alternate.select(F.col("field_id").alias("alternate_id"), key.alias("_key"))
    out = p.join(a, "_key", "left")
    if strict:
        if out.filter("alternate_id IS NULL").limit(1).count():
            raise ValueError("a primary field has no alternate")
        if a.groupBy("_key").count().filter("count > 1").limit(1).count():
            raise ValueError("a field has more than one alternate")
    return out.select("primary_id", "alternate_id", F.col("_key").alias("matched_on"))


def overwrite(cells: DataFrame, patch: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Replace the cells that `patch` holds, masked ones included."""
    new = patch.select(*keys, F.col(value).alias("_new"), F.lit(True).alias("_patched"))
    out = cells.join(new, keys, "left")
    return out.withColumn(value, F.when(F.col("_patched"), F.col("_new")).otherwise(F.col(value))).drop("_new", "_patched")


def concatenate(parts: list[DataFrame], keys: list[str], strict: bool = True) -> DataFrame:
    """One field from disjoint parts; a cell held twice raises."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if strict and out.groupBy(*keys).count().filter("count > 1").limit(1).count():
        raise ValueError("the parts overlap")
    return out


def mask_by(cells: DataFrame, other: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Mask cells where the other field is masked or absent."""
    m = other.select(*keys, F.col(value).isNotNull().alias("_ok"))
    out = cells.join(m, keys, "left")
    return out.withColumn(value, F.when(F.coalesce("_ok", F.lit(False)), F.col(value))).drop("_ok")


def crop(
    cells: DataFrame, axis_y: DataFrame, axis_x: DataFrame, tgt_y: DataFrame, tgt_x: DataFrame, pad: int = 1, period: float | None = 360.0,
) -> DataFrame:
    """Source cells under the target's bounding box plus `pad` cells around; longitude is periodic."""
    f_y, f_x, ey, ex = facts(axis_y, axis_x, tgt_y, tgt_x)
    ys = overlapping_indices(axis_y, ey.lo, ey.hi, pad).select(F.col("idx").alias("y"))
    whole = period and ex.hi - ex.lo >= period - 1e-9
    out = cells.join(small(ys, f_y.n), "y", "left_semi")
    if whole:
        return out
    xs = overlapping_indices(axis_x, ex.lo, ex.hi, pad, period).select(F.col("idx").alias("x"))
    return out.join(small(xs, f_x.n), "x", "left_semi")
