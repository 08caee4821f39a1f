"""Horizontal regridding of long-form fields.

Rectilinear weights are separable: an interval join on each axis gives two small tables ``(src, tgt, w)`` of at most a
few rows per axis cell.  Cells look both up and are summed once per target cell, so the field is shuffled a single time
(partially aggregated before) whatever the grids are.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.columns import TOLERANCE, isclose, nan
from gridloom.functions.projection import System, from_geographic, in_degrees, to_geographic, to_rotated
from gridloom.operators.curved import corners_from_axes, curved_weights
from gridloom.session import small, within_tasks
from gridloom.sources.mesh import face_corners
from gridloom.sources.axes import facts, overlapping_indices, regular_axis, regular_cover


# Axis expressions are given as SQL text: one call to the JVM each, where a tree of Column calls costs dozens.


def _pieces(axis: DataFrame, base: float | None, period: float) -> DataFrame:
    """Axis cells as ascending intervals; with a base, cells crossing base + period are cut in two."""
    a = axis.selectExpr("idx", "least(lo, hi) AS a", "greatest(lo, hi) AS b")
    if base is None:
        return a
    end = base + period
    # A start a rounding error below the base is the base itself, not the far end.
    a = a.selectExpr("idx", "b - a AS len", f"pmod(a - {base!r}D, {period!r}D) + {base!r}D AS s")
    a = a.selectExpr("idx", "len", f"IF({end!r}D - s <= {TOLERANCE!r}D, {base!r}D, s) AS s")
    whole = f"named_struct('a', s, 'b', least(s + len, {end!r}D))"
    rest = f"named_struct('a', {base!r}D, 'b', s + len - {period!r}D)"
    return a.selectExpr(
        "idx", f"inline(IF(s + len > {end + TOLERANCE!r}D, array({whole}, {rest}), array({whole}))) AS (a, b)"
    )


def interval_overlaps(src: DataFrame, tgt: DataFrame, period: float | None = None, base: float | None = None) -> DataFrame:
    """Overlapping pairs of two interval tables ``(idx, lo, hi)`` as ``(src, tgt, a, b)``.

    Intervals are cut into bins of the target's mean width and met by equality of the bin; a pair is kept in the
    first bin both share, so no pair appears twice.
    """
    f_src, f_tgt = facts(src, tgt)
    width = max((f_tgt.hi - f_tgt.lo) / f_tgt.n, 1e-12)
    if period is not None and base is None:
        base = f_src.lo
    s = _pieces(src, base if period else None, period or 0.0)
    t = _pieces(tgt, base if period else None, period or 0.0)

    def binned(df, prefix):
        low, high = f"floor(a / {width!r}D)", f"floor(b / {width!r}D)"
        return df.selectExpr(
            f"idx AS {prefix}", f"a AS {prefix}_a", f"b AS {prefix}_b", f"{low} AS {prefix}_first", f"explode(sequence({low}, {high})) AS bin"
        )

    pairs = binned(s, "src").join(binned(t, "tgt"), "bin")
    low, high = "greatest(src_a, tgt_a)", "least(src_b, tgt_b)"
    return pairs.filter(f"bin = greatest(src_first, tgt_first) AND {high} > {low}").selectExpr(
        "src", "tgt", f"{low} AS a", f"{high} AS b"
    )


def _sin_degrees(c: Column) -> Column:
    return F.sin(F.radians(F.least(F.greatest(c, F.lit(-90.0)), F.lit(90.0))))


def axis_weights(
    src: DataFrame, tgt: DataFrame, names: tuple[str, str], spherical: bool = False, period: float | None = None
) -> DataFrame:
    """Overlap measure per pair of cells: ``(src, tgt, w, inside)``; inside = target cell lies within the source's extent.

    Pieces of one pair cut by the period are added up.  Slivers thinner than the tolerance are no overlap.
    """
    s, t = facts(src, tgt)
    circular = bool(period) and abs(s.hi - s.lo - period) <= 1e-5 * period
    pairs = interval_overlaps(src, tgt, period, s.lo)
    sine = "sin(radians(least(greatest({}, -90D), 90D)))"
    size = f"{sine.format('b')} - {sine.format('a')}" if spherical else "b - a"
    keep = pairs.filter(f"b - a > {TOLERANCE!r}D")
    w = keep.groupBy("src", "tgt").agg(F.expr(f"sum({size}) AS w"))
    if circular:
        w = w.withColumn("inside", F.lit(True))
    elif t.lo >= s.lo - 1e-9 and t.hi <= s.hi + 1e-9 and not period:
        w = w.withColumn("inside", F.lit(True))
    else:
        covered = pairs.groupBy("tgt").agg(F.expr("sum(b - a) AS len"))
        full = tgt.selectExpr("idx AS tgt", "abs(hi - lo) AS size")
        w = w.join(covered, "tgt").join(full, "tgt").selectExpr("src", "tgt", "w", "len >= size - 1e-9D * greatest(size, 1D) AS inside")
    w = w.selectExpr(f"src AS {names[0]}", f"tgt AS {names[1]}", f"w AS _w{names[0]}", f"inside AS _in{names[0]}")
    # Cells of an axis do not overlap each other, so two axes meet in fewer pairs than they have edges (twice, if cut).
    return small(w, at_most=2 * (s.n + t.n))


def weigh_cells(cells: DataFrame, wy: DataFrame, wx: DataFrame, keys: list[str] | None = None, n: int = 0) -> DataFrame:
    """Cells with target indices ``_ty, _tx`` and weight ``_w``, looked up axis by axis.

    With `keys`, cells are dealt out by them between the two lookups, for `n` target cells.
    """
    if keys:
        return within_tasks(cells.join(wy, "y"), n, *keys).join(wx, "x").withColumn("_w", F.expr("_wx * _wy"))
    return cells.join(wx, "x").join(wy, "y").withColumn("_w", F.expr("_wx * _wy"))


def area_weighted(
    cells: DataFrame,
    src_y: DataFrame,
    src_x: DataFrame,
    tgt_y: DataFrame,
    tgt_x: DataFrame,
    by: list[str] | None = None,
    value: str = "value",
    period: float | None = 360.0,
    spherical: bool = True,
    stdev: bool = False,
) -> DataFrame:
    """Area-weighted mean (and deviation) of the source cells under each target cell.

    Masked source cells do not count; a target cell is masked if nothing counts and NaN if it is not wholly inside the
    source's extent.  The deviation is sqrt(abs(mean(v^2) - mean(v)^2)).  Target cells over no source row at all are
    absent; `complete` adds them.
    """
    by = by or []
    f = facts(src_y, src_x, tgt_y, tgt_x)
    wx = axis_weights(src_x, tgt_x, ("x", "_tx"), False, period)
    wy = axis_weights(src_y, tgt_y, ("y", "_ty"), spherical, None)
    # On a finer grid a few cells become very many: they are dealt out by target row before they meet the columns, and summed there.
    finer = f[3].n > f[1].n and f[2].n > f[0].n
    rows = weigh_cells(cells, wy, wx, [*by, "_ty"] if finer else None, f[2].n * f[3].n)
    aggs = [
        F.expr(f"sum({value} * _w) AS _vw"), F.expr(f"sum(IF({value} IS NOT NULL, _w, NULL)) AS _sw"),
        F.expr("bool_and(_inx AND _iny) AS _inside"),
    ]
    if stdev:
        aggs.append(F.expr(f"sum({value} * {value} * _w) AS _vvw"))
    out = rows.groupBy(*by, F.expr("_ty AS y"), F.expr("_tx AS x")).agg(*aggs)
    outputs = [f"IF(_inside, _vw / _sw, double('NaN')) AS {value}"]
    if stdev:
        outputs.append("IF(_inside, sqrt(abs(_vvw / _sw - (_vw / _sw) * (_vw / _sw))), double('NaN')) AS stdev")
    return out.selectExpr(*by, "y", "x", *outputs)


def area_shares(
    cells: DataFrame, src_y: DataFrame, src_x: DataFrame, tgt_y: DataFrame, tgt_x: DataFrame, by: list[str], period: float | None = 360.0, spherical: bool = True,
) -> DataFrame:
    """Area ``_w`` that the source cells of each group of `by` (a NULL is a group) cover of each target cell, and whether it is ``_inside``."""
    facts(src_y, src_x, tgt_y, tgt_x)
    wx = axis_weights(src_x, tgt_x, ("x", "_tx"), False, period)
    wy = axis_weights(src_y, tgt_y, ("y", "_ty"), spherical, None)
    rows = weigh_cells(cells, wy, wx)
    out = rows.groupBy(*by, "_ty", "_tx").agg(F.sum("_w").alias("_w"), F.expr("bool_and(_inx AND _iny) AS _inside"))
    return out.withColumnRenamed("_ty", "y").withColumnRenamed("_tx", "x")


def complete(cells: DataFrame, ny: int, nx: int, by: list[str] | None = None, value: str = "value") -> DataFrame:
    """Add masked rows for cells that do not exist, for every group present."""
    by = by or []
    spark = cells.sparkSession
    if by:
        grid = (
            cells.select(*by).distinct()
            .withColumn("y", F.explode(F.sequence(F.lit(0), F.lit(ny - 1))))
            .withColumn("x", F.explode(F.sequence(F.lit(0), F.lit(nx - 1))))
        )
    else:
        grid = spark.range(ny * nx).select(
            F.expr(f"CAST(id DIV {nx} AS INT)").alias("y"), F.expr(f"CAST(id % {nx} AS INT)").alias("x")
        )
        grid = within_tasks(grid, ny * nx, "y", "x")
    return grid.join(cells.select(*by, "y", "x", value), by + ["y", "x"], "left")


def _segments(src: DataFrame, period: float | None) -> tuple[DataFrame, float, float]:
    """Stretches between neighbouring points ``(i0, p0, i1, p1, bin)``, the bins' width, and where the last one ends.

    An axis is as long as one side of the grid, so its window is small.  With a period the last point is joined to the first.
    """
    (f,) = facts(src)
    width = max((f.p_hi - f.p_lo) / f.n, 1e-12)
    seg = src.selectExpr("idx AS i0", "point AS p0", "lead(idx) OVER (ORDER BY point) AS i1", "lead(point) OVER (ORDER BY point) AS p1")
    if period:
        seg = seg.selectExpr("i0", "p0", f"coalesce(i1, {f.first}) AS i1", f"coalesce(p1, {f.p_lo + period!r}D) AS p1")
    seg = seg.filter("p1 IS NOT NULL").selectExpr("*", f"explode(sequence(floor(p0 / {width!r}D), floor(p1 / {width!r}D))) AS bin")
    # Stretches touch each other, so they lie in at most two bins each and once more in every bin they span.
    return small(seg, at_most=3 * f.n + 3), width, f.p_lo + period if period else f.p_hi


def _between(points: DataFrame, column: str, src: DataFrame, period: float | None, mode: str = "nan") -> DataFrame:
    """Points with the stretch they lie on: ``i0, i1``, the share `f` of the way to the second, and `inside`."""
    (f,) = facts(src)
    seg, width, last = _segments(src, period)
    if period:
        t = points.selectExpr("*", f"pmod({column} - {f.p_lo!r}D, {period!r}D) + {f.p_lo!r}D AS _p").selectExpr("*", "_p AS _c", "true AS inside")
    else:
        t = points.selectExpr("*", f"{column} AS _p", f"least(greatest({column}, {f.p_lo!r}D), {f.p_hi!r}D) AS _c")
        t = t.selectExpr("*", f"abs(_c - _p) <= {TOLERANCE!r}D AS inside" if mode == "nan" else "true AS inside")
    t = t.selectExpr("*", f"floor(_c / {width!r}D) AS bin")
    j = t.join(seg, "bin").filter(f"_c >= p0 AND (_c < p1 OR (p1 = {last!r}D AND _c = {last!r}D))")
    return j.selectExpr(*points.columns, "inside", "i0", "i1", "(_p - p0) / (p1 - p0) AS f")


def brackets(src: DataFrame, tgt: DataFrame, names: tuple[str, str], mode: str = "nan", period: float | None = None) -> DataFrame:
    """Linear weights per axis: two rows ``(src, tgt, w, inside)`` per target point, one where a weight is zero.

    `mode` 'nan' marks points beyond the outermost source points, 'linear' extrapolates from the end pair.  With a period
    the last source point is joined to the first.
    """
    j = _between(tgt.selectExpr("idx AS t", "point AS at"), "at", src, period, mode)
    j = j.selectExpr("t", "inside", "inline(array(struct(i0 AS s, 1 - f AS w), struct(i1 AS s, f AS w))) AS (s, w)")
    return j.filter("w <> 0").selectExpr(f"s AS {names[0]}", f"t AS {names[1]}", f"w AS _w{names[0]}", f"inside AS _in{names[0]}")


def _gather(rows: DataFrame, by: list[str], value: str, need: str) -> DataFrame:
    out = rows.groupBy(*by, F.expr("_ty AS y"), F.expr("_tx AS x")).agg(
        F.expr(f"sum({value} * _w) AS _vw"), F.expr(f"count({value}) AS _n"), F.expr(f"max({need}) AS _need"),
        F.expr("bool_and(_inx AND _iny) AS _inside"),
    )
    return out.selectExpr(*by, "y", "x", f"IF(_inside, IF(_n = _need, _vw, NULL), double('NaN')) AS {value}")


def bilinear(
    cells: DataFrame,
    src_y: DataFrame,
    src_x: DataFrame,
    tgt_y: DataFrame,
    tgt_x: DataFrame,
    by: list[str] | None = None,
    value: str = "value",
    mode: str = "nan",
    period: float | None = None,
) -> DataFrame:
    """Bilinear interpolation at target points; masked if a contributing source cell is masked or absent."""
    by = by or []
    _, _, t_y, t_x = facts(src_y, src_x, tgt_y, tgt_x)
    wx = brackets(src_x, tgt_x, ("x", "_tx"), mode, period)
    wy = brackets(src_y, tgt_y, ("y", "_ty"), mode)
    wx = small(wx.withColumn("_cx", F.count(F.lit(1)).over(Window.partitionBy("_tx"))), at_most=2 * t_x.n)
    wy = small(wy.withColumn("_cy", F.count(F.lit(1)).over(Window.partitionBy("_ty"))), at_most=2 * t_y.n)
    return _gather(weigh_cells(cells, wy, wx), by, value, "_cx * _cy")


def nearest_weights(src: DataFrame, tgt: DataFrame, names: tuple[str, str], period: float | None = None) -> DataFrame:
    """One row per target point: the source index whose point is nearest (the upper one half way between two)."""
    lin = brackets(src, tgt, ("s", "t"), "linear", period)
    return lin.groupBy(F.col("t").alias(names[1])).agg(F.max_by("s", F.struct(F.round("_ws", 9), "s")).alias(names[0]))


def seed_indices(axis: DataFrame, seeds: DataFrame, strict: bool = True) -> DataFrame:
    """Index nearest to each seed ``(id, point)`` on an axis, the lower one on ties, as ``(id, idx)``.

    A seed beyond the outermost points raises, or is left out if not `strict`.
    """
    t = seeds.select(F.col("id").alias("idx"), "point")
    lin = brackets(axis, t, ("s", "t"), "nan")
    if strict and lin.filter("NOT _ins").limit(1).count():
        raise ValueError("a seed lies outside the axis")
    pick = F.min_by("s", F.struct(-F.round("_ws", 9), F.col("s"))).alias("idx")
    return lin.filter("_ins").groupBy(F.col("t").alias("id")).agg(pick)


def nearest(
    cells: DataFrame,
    src_y: DataFrame,
    src_x: DataFrame,
    tgt_y: DataFrame,
    tgt_x: DataFrame,
    period: float | None = None,
) -> DataFrame:
    """Every column of the source cell nearest to each target point; no aggregation, hence no shuffle of the field."""
    _, _, t_y, t_x = facts(src_y, src_x, tgt_y, tgt_x)
    wx = small(nearest_weights(src_x, tgt_x, ("x", "_tx"), period), at_most=t_x.n)
    wy = small(nearest_weights(src_y, tgt_y, ("y", "_ty")), at_most=t_y.n)
    out = cells.join(wx, "x").join(wy, "y").drop("x", "y")
    return out.withColumnRenamed("_ty", "y").withColumnRenamed("_tx", "x")


def zonal_target(src_x: DataFrame, tgt_x: DataFrame, period: float = 360.0) -> DataFrame:
    """Target longitude axis to use: one cell over the whole circle if the source is a single global column."""
    s, t = facts(src_x, tgt_x)
    both_global = all(abs(e.hi - e.lo - period) <= 1e-5 * period for e in (s, t))
    if not (both_global and s.n == 1 and t.n > 1):
        return tgt_x
    return regular_axis(tgt_x.sparkSession, 1, t.lo, t.hi - t.lo)


def outline_box(
    axis_y: DataFrame, axis_x: DataFrame, system: System, other: System, period: float = 360.0, steps: int = 64,
) -> tuple[float, float, float, float]:
    """Box ``(v_lo, v_hi, u_lo, u_hi)`` in another system around a grid's outline.

    The outline is followed in `steps` points per side.  Longitudes are the shortest arc that holds them all, so the box may cross the
    date line; a grid that holds a pole of the other system reaches it all around.
    """
    spark = axis_y.sparkSession
    e_y, e_x = facts(axis_y, axis_x)
    share = [k / steps for k in range(steps)]
    ring = [(e_y.lo, e_x.lo + s * (e_x.hi - e_x.lo)) for s in share] + [(e_y.lo + s * (e_y.hi - e_y.lo), e_x.hi) for s in share]
    ring += [(e_y.hi, e_x.hi - s * (e_x.hi - e_x.lo)) for s in share] + [(e_y.hi - s * (e_y.hi - e_y.lo), e_x.lo) for s in share]

    def moved(points: list[tuple[float, float]], start: System, end: System) -> list[tuple[float, float]]:
        v, u = from_geographic(*to_geographic(F.col("v"), F.col("u"), start), end)
        return [tuple(r) for r in spark.createDataFrame(points, "v DOUBLE, u DOUBLE").select(v, u).collect()]  # as many as were given

    found = moved(ring, system, other)
    v_lo, v_hi = min(v for v, _ in found), max(v for v, _ in found)
    if not in_degrees(other):
        return v_lo, v_hi, min(u for _, u in found), max(u for _, u in found)
    around = False
    for pole, (v, u) in zip((-90.0, 90.0), moved([(-90.0, 0.0), (90.0, 0.0)], other, system)):
        if in_degrees(system):
            u = (u - e_x.lo) % period + e_x.lo
        if e_y.lo <= v <= e_y.hi and e_x.lo <= u <= e_x.hi:
            around = True
            v_lo, v_hi = (pole, v_hi) if pole < 0 else (v_lo, pole)
    turns = sorted(u % period for _, u in found)
    gap, start = max((b - a, b) for a, b in zip(turns, [*turns[1:], turns[0] + period]))
    if around or gap < period / steps:
        return v_lo, v_hi, -period / 2, period / 2
    start %= period
    return v_lo, v_hi, start, start + period - gap


def overlap_axes(
    axis_y: DataFrame, axis_x: DataFrame, other_y: DataFrame, other_x: DataFrame, system: System, other: System, period: float | None, pad: int = 1,
) -> tuple[DataFrame, DataFrame]:
    """The part of a grid's axes under another grid of another system, `pad` cells more on each side; longitudes go on past the date line."""
    v_lo, v_hi, u_lo, u_hi = outline_box(other_y, other_x, other, system)
    f_y, f_x = facts(axis_y, axis_x)
    y = axis_y.join(small(overlapping_indices(axis_y, v_lo, v_hi, pad), f_y.n), "idx")
    turn = period if in_degrees(system) else None
    if turn and u_hi - u_lo >= turn - 1e-9:
        return y, axis_x
    x = axis_x.join(small(overlapping_indices(axis_x, u_lo, u_hi, pad, turn), f_x.n), "idx")
    if turn:
        base = u_lo - 2 * (pad + 1) * (f_x.hi - f_x.lo) / f_x.n
        low = F.least("lo", "hi")
        x = x.withColumn("_by", F.pmod(low - F.lit(base), F.lit(turn)) + F.lit(base) - low)
        x = x.select("idx", *[(F.col(c) + F.col("_by")).alias(c) for c in ("point", "lo", "hi")])
    return y, x


def two_stage(
    cells: DataFrame,
    src_y: DataFrame,
    src_x: DataFrame,
    tgt_y: DataFrame,
    tgt_x: DataFrame,
    by: list[str] | None = None,
    value: str = "value",
    src_system: System = None,
    tgt_system: System = None,
    period: float | None = 360.0,
) -> DataFrame:
    """Area-weighted regrid, preceded by bilinear interpolation into the target's system if the systems differ.

    Source and target are cropped to each other first: the intermediate grid covers what is left of the target with as many cells as are
    left of the source.  Its points are transformed into the source's system, where each finds its four surrounding source points.
    """
    if src_system == tgt_system:
        tgt_x = zonal_target(src_x, tgt_x) if period else tgt_x
        return area_weighted(cells, src_y, src_x, tgt_y, tgt_x, by, value, period if in_degrees(tgt_system) else None, in_degrees(tgt_system))
    by = by or []
    under = overlap_axes(src_y, src_x, tgt_y, tgt_x, src_system, tgt_system, period)
    over = overlap_axes(tgt_y, tgt_x, *under, tgt_system, src_system, period)
    ny, nx = (f.n for f in facts(*under, *over)[:2])
    mid_y, mid_x = regular_cover(over[0], ny), regular_cover(over[1], nx)
    spark = cells.sparkSession
    pts = spark.range(ny * nx).select(
        F.expr(f"CAST(id DIV {nx} AS INT)").alias("_ty"), F.expr(f"CAST(id % {nx} AS INT)").alias("_tx")
    )
    pts = pts.join(small(mid_y.select(F.col("idx").alias("_ty"), F.col("point").alias("_v")), at_most=ny), "_ty")
    pts = pts.join(small(mid_x.select(F.col("idx").alias("_tx"), F.col("point").alias("_u")), at_most=nx), "_tx")
    v, u = from_geographic(*to_geographic(F.col("_v"), F.col("_u"), tgt_system), src_system)
    pts = pts.select("_ty", "_tx", v.alias("_lat"), u.alias("_lon"))
    near = scattered_linear_weights(pts, src_y, src_x, period if in_degrees(src_system) else None)
    rows = near.join(cells, ["y", "x"]).withColumn("_inx", F.col("_inside")).withColumn("_iny", F.lit(True))
    mid = _gather(rows, by, value, "_need")
    degrees = in_degrees(tgt_system)
    return area_weighted(mid, mid_y, mid_x, tgt_y, tgt_x, by, value, period if degrees else None, degrees)


def scattered_linear_weights(points: DataFrame, src_y: DataFrame, src_x: DataFrame, period: float | None) -> DataFrame:
    """Four corner weights for points ``(_ty, _tx, _lat, _lon)`` that follow no axis, between the points of any monotonic source axes.

    The period holds if the source axis closes around the globe.
    """
    f_x = facts(src_x)[0]
    if period and f_x.hi - f_x.lo < period - 1e-5 * period:
        # An axis that does not close has ends; points are turned to its side of the globe first.
        points = points.withColumn("_lon", F.pmod(F.col("_lon") - F.lit(f_x.lo), F.lit(period)) + F.lit(f_x.lo))
        period = None
    p = _between(points, "_lat", src_y, None).selectExpr("_ty", "_tx", "_lon", "inside AS _iy", "i0 AS _y0", "i1 AS _y1", "f AS _fy")
    p = _between(p, "_lon", src_x, period)
    corner = "struct(_y{j} AS y, i{i} AS x, {fy} * {fx} AS w)"
    corners = [corner.format(j=j, i=i, fy="_fy" if j else "(1 - _fy)", fx="f" if i else "(1 - f)") for j in (0, 1) for i in (0, 1)]
    p = p.selectExpr("_ty", "_tx", "_iy AND inside AS _inside", f"filter(array({', '.join(corners)}), c -> c.w <> 0) AS _cs")
    return p.selectExpr("_ty", "_tx", "_inside", "size(_cs) AS _need", "inline(_cs)").selectExpr("_ty", "_tx", "_inside", "_need", "y", "x", "w AS _w")


def apply_weights(
    cells: DataFrame, weights: DataFrame, by: list[str] | None = None, value: str = "value",
    normalise: bool = False, digits: int | None = None,
) -> DataFrame:
    """Regrid by a stored weights table ``(src_cell, tgt_cell, w)``.

    A masked source cell masks every target it touches.  `normalise` divides by the covered fraction; a NaN that appears
    though no contributing value was NaN (a fraction of zero) shows as NaN for `unexpected_nan` to find.
    """
    by = by or []
    rows = cells.join(weights, "src_cell")
    v = F.col(value)
    out = rows.groupBy(*by, "tgt_cell").agg(
        F.sum(v * F.col("w")).alias("_vw"), F.sum("w").alias("_sw"),
        F.bool_or(v.isNull()).alias("_masked"),
    )
    res = F.col("_vw")
    if normalise:
        res = F.when(F.col("_sw") == 0, nan()).otherwise(F.col("_vw") / F.col("_sw"))
    if digits is not None:
        res = F.round(res, digits)
    return out.select(*by, "tgt_cell", F.when(~F.col("_masked"), res).alias(value))


def to_mesh(
    cells: DataFrame, src_y: DataFrame, src_x: DataFrame, faces: DataFrame, nodes: DataFrame, by: list[str] | None = None, value: str = "value",
    start_index: int = 1, digits: int = 12,
) -> DataFrame:
    """A field on a regular grid to the faces of a mesh, conservatively: ``(by..., face_id, value)``.

    A global source of one column is split first.  Faces that no source cell covers are absent; NaN that the source does not have raises.
    """
    s_y, s_x = facts(src_y, src_x)
    if s_x.n == 1 and s_x.hi - s_x.lo > 180.0:
        parts = 12
        cells, src_x = split_column(cells, parts), regular_axis(cells.sparkSession, parts, s_x.lo, (s_x.hi - s_x.lo) / parts)
        s_x = facts(src_x)[0]
    weights = curved_weights(corners_from_axes(src_y, src_x, s_y.n, s_x.n), face_corners(faces, nodes, start_index).withColumnRenamed("face_id", "cell"))
    numbered = cells.withColumn("src_cell", F.col("y").cast("long") * s_x.n + F.col("x"))
    out = apply_weights(numbered, weights, by, value, normalise=True, digits=digits)
    unexpected_nan(out, cells, value)
    return out.withColumnRenamed("tgt_cell", "face_id")


def split_column(cells: DataFrame, parts: int = 12) -> DataFrame:
    """A source with one global column becomes `parts` equal columns, so that cells are narrower than half the globe."""
    return cells.drop("x").withColumn("x", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))


def unexpected_nan(result: DataFrame, source: DataFrame, value: str = "value") -> None:
    """Raise if the result holds NaN although the source holds none."""
    bad = F.isnan(value)
    if result.filter(bad).limit(1).count() and not source.filter(bad).limit(1).count():
        raise ValueError("regridding produced NaN from a source without NaN")


def rectilinear_weights(src_y, src_x, tgt_y, tgt_x, period: float | None = 360.0) -> DataFrame:
    """Sparse conservative weights ``(sy, sx, ty, tx, w)``: overlap area over target area, sums to 1 where covered."""
    wx = axis_weights(src_x, tgt_x, ("sx", "tx"), False, period)
    wy = axis_weights(src_y, tgt_y, ("sy", "ty"), True, None)
    fx = tgt_x.select(F.col("idx").alias("tx"), F.abs(F.col("hi") - F.col("lo")).alias("_lx"))
    fy = tgt_y.select(F.col("idx").alias("ty"), F.abs(_sin_degrees(F.col("hi")) - _sin_degrees(F.col("lo"))).alias("_ly"))
    wx = wx.join(fx, "tx").select("sx", "tx", (F.col("_wsx") / F.col("_lx")).alias("wx"))
    wy = wy.join(fy, "ty").select("sy", "ty", (F.col("_wsy") / F.col("_ly")).alias("wy"))
    ny, nx = (f.n for f in facts(src_y, src_x))
    cell = src_y.sparkSession.range(ny * nx).select(
        F.expr(f"CAST(id DIV {nx} AS INT)").alias("sy"), F.expr(f"CAST(id % {nx} AS INT)").alias("sx")
    )
    out = cell.join(wx, "sx").join(wy, "sy")
    return out.select("sy", "sx", "ty", "tx", (F.col("wx") * F.col("wy")).alias("w"))


def transform_box(lat_min: float, lat_max: float, lon_min: float, lon_max: float, spark, pole: tuple[float, float], steps: int = 21) -> DataFrame:
    """Box in a rotated system around a latitude-longitude box, from points along its edges."""
    i = F.col("id") / F.lit(float(steps - 1))
    edge = spark.range(steps)
    lat, lon = F.lit(lat_min) + i * (lat_max - lat_min), F.lit(lon_min) + i * (lon_max - lon_min)
    pts = (
        edge.select(lat.alias("lat"), F.lit(lon_min).alias("lon"))
        .unionByName(edge.select(lat.alias("lat"), F.lit(lon_max).alias("lon")))
        .unionByName(edge.select(F.lit(lat_min).alias("lat"), lon.alias("lon")))
        .unionByName(edge.select(F.lit(lat_max).alias("lat"), lon.alias("lon")))
    )
    v, u = to_rotated(F.col("lat"), F.col("lon"), *pole)
    return pts.agg(F.min(u).alias("u_min"), F.max(u).alias("u_max"), F.min(v).alias("v_min"), F.max(v).alias("v_max"))


def same_grid(a: DataFrame, b: DataFrame, keys: list[str] | None = None, check_bounds: bool = True) -> DataFrame:
    """One row ``(equal)``: do two axis tables ``(axis, idx, point, lo, hi)`` agree within the tolerance?"""
    keys = keys or ["axis", "idx"]
    l, r = a.alias("l"), b.alias("r")
    j = l.join(r, [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys], "full_outer")
    test = F.coalesce(isclose(F.col("l.point"), F.col("r.point"), 1e-10, 1e-8), F.lit(False))
    if check_bounds:
        for c in ("lo", "hi"):
            test = test & F.coalesce(isclose(F.col("l." + c), F.col("r." + c), 1e-10, 1e-8), F.lit(False))
    return j.agg(F.coalesce(F.bool_and(test), F.lit(True)).alias("equal"))
