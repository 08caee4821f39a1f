"""Axis tables ``(idx, point, lo, hi)``: generation, bounds, cropping, unions, run finding."""

from __future__ import annotations

from typing import NamedTuple
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.functions.columns import TOLERANCE, isclose, tolerant_key, wrap_lon
from gridloom.session import lookup


class Facts(NamedTuple):
    """What planning needs to know of an axis: size, outer bounds and points, index of the lowest point, narrowest gap."""

    n: int
    lo: float
    hi: float
    p_lo: float
    p_hi: float
    first: int
    gap: float


_KNOWN: WeakKeyDictionary[DataFrame, Facts] = WeakKeyDictionary()


def facts(*axes: DataFrame) -> list[Facts]:
    """Facts of axis tables; those not known by construction are found in one job for all of them."""
    unknown = [a for a in dict.fromkeys(axes) if a not in _KNOWN]
    if unknown:
        every = None
        for i, a in enumerate(unknown):
            bounds = [F.col(c) for c in (("lo", "hi", "point") if "lo" in a.columns else ("point", "point"))]
            near = a.selectExpr("*", "point - lag(point) OVER (ORDER BY point) AS gap")  # as long as one side of a grid
            one = near.agg(
                F.lit(i).alias("i"), F.count(F.lit(1)).alias("n"),
                F.min(F.least(*bounds)).alias("lo"), F.max(F.greatest(*bounds)).alias("hi"),
                F.min("point").alias("p_lo"), F.max("point").alias("p_hi"), F.min_by("idx", "point").alias("first"),
                F.coalesce(F.min("gap"), F.lit(0.0)).alias("gap"),
            )
            every = one if every is None else every.unionByName(one)
        for r in every.collect():  # one row per axis
            _KNOWN[unknown[r["i"]]] = Facts(r["n"], r["lo"], r["hi"], r["p_lo"], r["p_hi"], r["first"], r["gap"])
    return [_KNOWN[a] for a in axes]


def regular_axis(spark: SparkSession, n: int, start: float, step: float, first_point: float | None = None) -> DataFrame:
    """`n` equal cells from edge `start`; or, with `first_point`, cells centred on first_point + i * step."""
    if n < 1:
        raise ValueError("an axis needs at least one cell")
    edge = start if first_point is None else first_point - step / 2
    out = spark.range(0, n, 1, 1 + n // 1_000_000).selectExpr(
        "CAST(id AS INT) AS idx", f"{edge!r}D + (id + 0.5D) * {step!r}D AS point",
        f"{edge!r}D + id * {step!r}D AS lo", f"{edge!r}D + (id + 1) * {step!r}D AS hi",
    )
    ends, points = sorted((edge, edge + n * step)), sorted((edge + 0.5 * step, edge + (n - 0.5) * step))
    _KNOWN[out] = Facts(n, *ends, *points, 0 if step > 0 else n - 1, abs(step) if n > 1 else 0.0)
    return out


def regular_grid(
    spark: SparkSession,
    nx: int | None = None,
    ny: int | None = None,
    dx: float | None = None,
    dy: float | None = None,
    x0: float | None = None,
    y0: float | None = None,
    is_global: bool = True,
    north_first: bool = False,
    offset_poles: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Latitude and longitude axes of a regular grid from counts, steps and origins.

    Globally, counts and steps imply each other and must agree.  `offset_poles` puts the outermost points half a step
    from the poles; otherwise they sit on the poles and latitude has one point more.
    """
    if is_global:
        if nx and dx and dx != 360.0 / nx:
            raise ValueError("longitude step and count contradict each other on a global grid")
        dx = dx or (360.0 / nx if nx else None)
        gaps = ny if ny is None or offset_poles else ny - 1
        if gaps and dy and dy != 180.0 / gaps:
            raise ValueError("latitude step and count contradict each other on a global grid")
        dy = dy or (180.0 / gaps if gaps else None)
    if not dx or not dy:
        raise ValueError("the grid is underspecified: no step can be derived")
    nx = nx or round(360.0 / dx)
    ny = ny or round(180.0 / dy) + (0 if offset_poles else 1)
    if x0 is None:
        x0 = dx / 2 if offset_poles else 0.0
    if y0 is None:
        y0 = -90.0 + (dy / 2 if offset_poles else 0.0)
        if north_first:
            y0 = -y0
    step_y = -abs(dy) if north_first else abs(dy)
    y = regular_axis(spark, ny, 0.0, step_y, first_point=y0)
    y = y.select(
        "idx",
        "point",
        F.least(F.greatest("lo", F.lit(-90.0)), F.lit(90.0)).alias("lo"),
        F.least(F.greatest("hi", F.lit(-90.0)), F.lit(90.0)).alias("hi"),
    )
    return y, regular_axis(spark, nx, 0.0, dx, first_point=x0)


def grid_cells(y: DataFrame, x: DataFrame, nx: int) -> DataFrame:
    """All cells of a grid with their bounds, numbered by one range instead of a cross join."""
    spark = y.sparkSession
    ny = facts(y)[0].n
    cell = spark.range(ny * nx).select(
        F.expr(f"CAST(id DIV {nx} AS INT)").alias("y"), F.expr(f"CAST(id % {nx} AS INT)").alias("x")
    )
    ya = y.select(F.col("idx").alias("y"), F.col("point").alias("lat"), F.col("lo").alias("y_lo"), F.col("hi").alias("y_hi"))
    xa = x.select(F.col("idx").alias("x"), F.col("point").alias("lon"), F.col("lo").alias("x_lo"), F.col("hi").alias("x_hi"))
    return cell.join(ya, "y").join(xa, "x")


def variable_axis(points: DataFrame, edges: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Axis from irregular points and staggered edges, both ``(by..., idx, point)``; absent outer edges are mirrored.

    The edge list may lack the first, the last or both outer edges; a mirrored edge lies as far from the outer point
    as that point's inner edge.
    """
    if not by:
        one = F.lit(0).alias("_axis")
        return variable_axis(points.select(one, "*"), edges.select(one, "*"), ["_axis"]).drop("_axis")
    whole = Window.partitionBy(*by)
    first_point, last_point = F.min_by("point", "idx").over(whole), F.max_by("point", "idx").over(whole)
    first_edge = edges.filter("idx = 0").select(*by, F.col("point").alias("_e0"))
    p = points.withColumn("_first", first_point).withColumn("_last", last_point).join(first_edge, by)
    beyond = F.when(F.col("_last") > F.col("_first"), F.col("_e0") > F.col("_first")).otherwise(F.col("_e0") < F.col("_first"))
    p = p.withColumn("_shift", beyond.cast("int"))
    e = edges.withColumnRenamed("point", "_edge")
    lo = e.select(*by, F.col("idx").alias("_k"), F.col("_edge").alias("lo"))
    hi = e.select(*by, F.col("idx").alias("_j"), F.col("_edge").alias("hi"))
    p = p.withColumn("_k", F.col("idx") - F.col("_shift")).withColumn("_j", F.col("idx") - F.col("_shift") + 1)
    return (
        p.join(lo, by + ["_k"], "left")
        .join(hi, by + ["_j"], "left")
        .select(
            *by,
            "idx",
            "point",
            F.coalesce("lo", 2 * F.col("point") - F.col("hi")).alias("lo"),
            F.coalesce("hi", 2 * F.col("point") - F.col("lo")).alias("hi"),
        )
    )


def hybrid_levels(
    eta_theta: DataFrame, eta_rho: DataFrame, z_top: float, first_constant: int, by: list[str] | None = None, keep_zero: bool = False
) -> DataFrame:
    """Hybrid-height levels from two eta lists ``(by..., idx, eta)``; theta starts at level 0, rho at level 1.

    Heights are z_top * eta.  Sigma is (1 - eta / eta_ref)^2 below the first constant rho level and zero from there.
    Level 0 is dropped, its lower bounds pass to level 1.
    """
    if not by:
        one = F.lit(0).alias("_axis")
        lists = eta_theta.select(one, "*"), eta_rho.select(one, "*")
        return hybrid_levels(*lists, z_top, first_constant, ["_axis"], keep_zero).drop("_axis")
    w = Window.partitionBy(*by).orderBy("idx")
    ref = eta_rho.filter(F.col("idx") == first_constant).select(*by, F.col("eta").alias("_ref"))
    theta = eta_theta.withColumnRenamed("eta", "_et")
    rho = eta_rho.select(*by, "idx", F.col("eta").alias("_er")).unionByName(
        theta.filter("idx = 0").select(*by, "idx", F.lit(0.0).alias("_er"))
    )
    lv = theta.join(rho, by + ["idx"], "left")
    lv = lv.join(ref, by)

    def sigma(eta, level):
        return F.when(level < first_constant, F.pow(1 - eta / F.col("_ref"), F.lit(2.0))).otherwise(0.0)

    lv = (
        lv.withColumn("height", F.lit(z_top) * F.col("_et"))
        .withColumn("height_lo", F.lit(z_top) * F.col("_er"))
        .withColumn("height_hi", F.coalesce(F.lead("height_lo").over(w), 2 * F.col("height") - F.col("height_lo")))
        .withColumn("sigma", sigma(F.col("_et"), F.col("idx")))
        .withColumn("sigma_lo", sigma(F.col("_er"), F.col("idx")))
        .withColumn("sigma_hi", F.coalesce(F.lead("sigma_lo").over(w), F.lit(0.0)))
        .withColumn(
            "monotonic",
            F.coalesce(F.col("height") >= F.lag("height").over(w), F.lit(True))
            & F.coalesce(F.col("sigma") <= F.lag("sigma").over(w), F.lit(True)),
        )
    )
    if not keep_zero:
        prev_h, prev_s = F.lag("height_lo").over(w), F.lag("sigma_lo").over(w)
        lv = (
            lv.withColumn("height_lo", F.when(F.col("idx") == 1, prev_h).otherwise(F.col("height_lo")))
            .withColumn("sigma_lo", F.when(F.col("idx") == 1, prev_s).otherwise(F.col("sigma_lo")))
            .filter("idx > 0")
        )
    return lv.select(
        *by, F.col("idx").alias("level"), "height", "height_lo", "height_hi", "sigma", "sigma_lo", "sigma_hi", "monotonic"
    )


def guess_bounds(axis: DataFrame, by: list[str] | None = None, latitude: bool = False) -> DataFrame:
    """Bounds half way between neighbouring points; latitude bounds stay within the poles.

    Works on many axes at once; each axis (one group) is bounded by the length of a grid side.
    """
    by = by or []
    w = Window.partitionBy(*by).orderBy("idx")
    prev, nxt = F.lag("point").over(w), F.lead("point").over(w)
    lo = F.coalesce((prev + F.col("point")) / 2, F.col("point") - (nxt - F.col("point")) / 2)
    hi = F.coalesce((nxt + F.col("point")) / 2, F.col("point") + (F.col("point") - prev) / 2)
    if latitude:
        lo = F.least(F.greatest(lo, F.lit(-90.0)), F.lit(90.0))
        hi = F.least(F.greatest(hi, F.lit(-90.0)), F.lit(90.0))
    return axis.select(*by, "idx", "point", lo.alias("lo"), hi.alias("hi"))


def set_outer_bounds(axis: DataFrame, first: float, last: float, by: list[str] | None = None) -> DataFrame:
    """Force the outermost bounds, e.g. to the poles."""
    n = F.max("idx").over(Window.partitionBy(*(by or [])))
    return axis.select(
        *(by or []),
        "idx",
        "point",
        F.when(F.col("idx") == 0, F.lit(first)).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("idx") == n, F.lit(last)).otherwise(F.col("hi")).alias("hi"),
    )


def extent(axis: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Limits over points and bounds, per axis."""
    low, high = F.least("lo", "hi"), F.greatest("lo", "hi")
    return axis.groupBy(*(by or [])).agg(
        F.min(low).alias("lo"), F.max(high).alias("hi"), F.count(F.lit(1)).alias("n"),
    )


def covers(axis: DataFrame, period: float = 360.0, by: list[str] | None = None) -> DataFrame:
    """Does each axis span the whole period (circular longitude, or 180 for latitude)?"""
    e = extent(axis, by)
    return e.withColumn("is_global", isclose(F.col("hi") - F.col("lo"), F.lit(period)))


def reverse(axis: DataFrame, n: int) -> DataFrame:
    """Index counted from the other end; bounds are swapped so that lo still leads."""
    return axis.select((F.lit(n - 1) - F.col("idx")).cast("int").alias("idx"), "point", F.col("hi").alias("lo"), F.col("lo").alias("hi"))


def ascending(axis: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Axes numbered so that points ascend: those that descend are counted from the other end, their bounds swapped."""
    by = by or []
    ends = axis.groupBy(*by).agg((F.min_by("point", "idx") > F.max_by("point", "idx")).alias("_flip"), F.max("idx").alias("_last"))
    out = lookup(axis, ends, by) if by else axis.join(F.broadcast(ends))  # one row
    number = F.when(F.col("_flip"), F.col("_last") - F.col("idx")).otherwise(F.col("idx")).cast("int").alias("idx")
    bounds = [F.when(F.col("_flip"), F.col(b)).otherwise(F.col(a)).alias(a) for a, b in (("lo", "hi"), ("hi", "lo")) if a in axis.columns]
    return out.select(*by, number, "point", *bounds)


def ascending_cells(cells: DataFrame, axis: DataFrame, index: str = "y", by: list[str] | None = None) -> DataFrame:
    """Cells renumbered along one axis the way `ascending` renumbers that axis."""
    by = by or []
    ends = axis.groupBy(*by).agg((F.min_by("point", "idx") > F.max_by("point", "idx")).alias("_flip"), F.max("idx").alias("_last"))
    out = lookup(cells, ends, by) if by else cells.join(F.broadcast(ends))  # one row
    return out.withColumn(index, F.when(F.col("_flip"), F.col("_last") - F.col(index)).otherwise(F.col(index)).cast("int")).drop("_flip", "_last")


def overlapping_indices(axis: DataFrame, low: float, high: float, pad: int = 0, period: float | None = None) -> DataFrame:
    """Indices of the cells that overlap (low, high) at all, widened by `pad` cells; raises when there are none.

    With a period the cells are shifted by whole turns first and padding wraps around; otherwise it stops at the ends.
    """
    n = facts(axis)[0].n
    a, b = F.least("lo", "hi"), F.greatest("lo", "hi")
    if period:
        base = wrap_lon(a, low, period, endpoint=False)
        width = b - a
        hit = (base < F.lit(high) - F.lit(TOLERANCE)) | (base + width > F.lit(low + period) + F.lit(TOLERANCE))
    else:
        hit = (a < F.lit(high) - F.lit(TOLERANCE)) & (b > F.lit(low) + F.lit(TOLERANCE))
    found = axis.filter(hit).select("idx")
    if found.limit(1).count() == 0:
        raise ValueError(f"no cell of the axis overlaps ({low}, {high})")
    if pad:
        shifted = F.explode(F.sequence(F.col("idx") - pad, F.col("idx") + pad))
        found = found.select(shifted.alias("idx"))
        found = found.select(F.pmod("idx", F.lit(n)).cast("int").alias("idx")) if period else found.filter(F.col("idx").between(0, n - 1))
        found = found.distinct()
    return found


def contiguous_runs(indices: DataFrame, by: list[str] | None = None, col: str = "idx", block: int = 1 << 20) -> DataFrame:
    """Runs of consecutive indices as (first, last, size).

    Runs are found within blocks of indices, whatever a group's size; only runs that touch a block's border, at most two
    per block, are then strung together.
    """
    by = by or []
    number = F.floor(F.col(col) / block)
    w = Window.partitionBy(*by, "_b").orderBy(col)
    island = indices.select(*by, col).distinct().withColumn("_b", number).withColumn("_g", F.col(col) - F.row_number().over(w))
    runs = island.groupBy(*by, "_b", "_g").agg(F.min(col).alias("first"), F.max(col).alias("last")).drop("_g")
    start = F.col("_b") * block
    touches = (F.col("first") == start) | (F.col("last") == start + block - 1)
    edge = Window.partitionBy(*by).orderBy("first")
    border = runs.filter(touches).withColumn("_new", F.coalesce(F.lag("last").over(edge) != F.col("first") - 1, F.lit(True)).cast("int"))
    border = border.withColumn("_r", F.sum("_new").over(edge)).groupBy(*by, "_r").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    out = runs.filter(~touches).select(*by, "first", "last").unionByName(border.drop("_r"))
    return out.withColumn("size", F.col("last") - F.col("first") + 1)


def union_axes(a: DataFrame, b: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Union of two ascending axes' points, renumbered; points equal within the tolerance meet.

    `b` may extend `a` but must not interleave with it: offending points raise.
    """
    if not by:
        one = F.lit(0).alias("_axis")
        return union_axes(a.select(one, "*"), b.select(one, "*"), ["_axis"]).drop("_axis")
    ka = a.select(*by, tolerant_key(F.col("point")).alias("point"))
    kb = b.select(*by, tolerant_key(F.col("point")).alias("point"))
    span = ka.groupBy(*by).agg(F.min("point").alias("_lo"), F.max("point").alias("_hi"))
    extra = kb.join(ka, by + ["point"], "left_anti")
    inside = extra.join(span, by).filter((F.col("point") > F.col("_lo")) & (F.col("point") < F.col("_hi")))
    if inside.limit(1).count():
        raise ValueError("the second axis interleaves with the first")
    w = Window.partitionBy(*by).orderBy("point")
    return ka.unionByName(extra).distinct().select(*by, (F.row_number().over(w) - 1).cast("int").alias("idx"), "point")


def regular_cover(target: DataFrame, n: int) -> DataFrame:
    """`n` equal cells over the extent of `target`: the intermediate grid of a two-stage regrid."""
    (e,) = facts(target)
    return regular_axis(target.sparkSession, n, e.lo, (e.hi - e.lo) / n)
