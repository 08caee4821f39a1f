"""Nearest-valid-neighbour filling on grids and meshes, exact and without any group that grows with the data."""

from __future__ import annotations

import math
import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.operators.regrid import complete
from gridloom.session import discard, is_small, lookup, materialise, merged, row_count, small, within_tasks
from gridloom.sources.axes import facts

#: Distances that agree to this many decimals (unit sphere) are ties; the smaller cell number wins.
TIE_DIGITS = 9
#: Rows to either side that are compared one by one.
NEAR_ROWS = 9


def unit_xyz(lat: Column, lon: Column) -> list[Column]:
    la, lo = F.radians(lat), F.radians(lon)
    return [F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)]


def chord(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a, b = unit_xyz(lat1, lon1), unit_xyz(lat2, lon2)
    return F.sqrt(sum(((p - q) * (p - q) for p, q in zip(a, b)), F.lit(0.0)))


def nearest_valid(
    cells: DataFrame, axis_y: DataFrame, axis_x: DataFrame, circular: bool = True, value: str = "value",
    wanted: Column | None = None, excluded: Column | None = None,
) -> DataFrame:
    """For each missing cell of one field, the nearest valid cell: ``(y, x, src_y, src_x)``.

    Missing = NULL or NaN and `wanted`; valid = neither and not `excluded`.  Along a row the nearest valid cell is the next
    one to the left or to the right, which two running windows find.  Each missing cell then compares those two
    candidates row by row, over a growing band of rows, until no row further away can be nearer; where the gap is wider than `NEAR_ROWS`,
    a tree of boxes over the valid cells is searched instead.  The result is a materialised table.
    """
    f_y, f_x = facts(axis_y, axis_x)
    ny, nx = f_y.n, f_x.n
    step = f_y.gap
    present = F.col(value).isNotNull() & ~F.isnan(value)
    valid = present if excluded is None else present & ~excluded
    target = ~present if wanted is None else ~present & wanted
    flags = cells.select("y", "x", F.struct(valid.alias("ok"), target.alias("want")).alias("_flags"))
    dense = materialise(
        complete(flags, ny, nx, None, "_flags")
        .select("y", "x", F.coalesce("_flags.ok", F.lit(False)).alias("_ok"), F.coalesce("_flags.want", F.lit(False)).alias("_want"))
    )
    if not dense.filter("_want").limit(1).count():
        return materialise(dense.limit(0).select("y", "x", F.col("y").alias("src_y"), F.col("x").alias("src_x")))
    if not dense.filter("_ok").limit(1).count():
        raise ValueError("the field has no valid cell to fill from")
    ok_x = F.when(F.col("_ok"), F.col("x"))
    # Both run forward: a frame that ends with the row is gone through again for each cell of it.
    left, right = (F.last(ok_x, ignorenulls=True).over(Window.partitionBy("y").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)) for order in (F.asc("x"), F.desc("x")))
    if circular:
        whole = Window.partitionBy("y")
        left = F.coalesce(left, F.max(ok_x).over(whole))
        right = F.coalesce(right, F.min(ok_x).over(whole))
    cand = within_tasks(dense, ny * nx, "y").select(F.col("y").alias("cy"), "x", F.array_distinct(F.array_compact(F.array(left, right))).alias("cx"))
    cand = materialise(cand.filter(F.size("cx") > 0))
    lat = small(axis_y.select(F.col("idx").alias("y"), F.col("point").alias("lat")), ny)
    lat_c = small(axis_y.select(F.col("idx").alias("cy"), F.col("point").alias("clat")), ny)
    lon = small(axis_x.select(F.col("idx").alias("x"), F.col("point").alias("lon")), nx)
    lon_c = small(axis_x.select(F.col("idx").alias("sx"), F.col("point").alias("clon")), nx)
    nothing = "CAST(NULL AS STRUCT<d: DOUBLE, cell: BIGINT>)"
    open_ = dense.filter("_want").join(lat, "y").join(lon, "x").select("y", "x", "lat", "lon", F.expr(nothing).alias("best"))
    done, inner, radius = [], -1, 1
    while radius <= NEAR_ROWS or radius >= ny - 1:
        ring = F.filter(F.sequence(F.lit(-radius), F.lit(radius)), lambda d: (F.abs(d) > inner))
        probe = open_.withColumn("_step", F.explode(ring)).withColumn("cy", F.col("y") + F.col("_step"))
        probe = probe.drop("_step").filter(F.col("cy").between(0, ny - 1))
        pairs = (
            probe.join(cand, ["cy", "x"]).withColumn("sx", F.explode("cx")).join(lat_c, "cy").join(lon_c, "sx")
            .withColumn("d", F.round(chord(F.col("lat"), F.col("lon"), F.col("clat"), F.col("clon")), TIE_DIGITS))
        )
        found = pairs.groupBy("y", "x").agg(
            F.min(F.struct("d", (F.col("cy").cast("long") * nx + F.col("sx")).alias("cell"))).alias("near")
        )
        state = open_.join(found, ["y", "x"], "left").withColumn("best", F.least("best", "near")).drop("near")
        # Rows beyond the band are at least (radius + 1) steps of latitude away.
        beyond = 2 * F.sin(F.radians(F.lit(min((radius + 1) * step, 180.0))) / 2) - 10.0 ** (1 - TIE_DIGITS)
        closed = (F.col("best.d") < beyond) if radius < ny - 1 else F.lit(True)
        state = materialise(state.withColumn("_closed", F.coalesce(closed, F.lit(False))))
        done.append(state)
        open_ = state.filter("NOT _closed").drop("_closed")
        if radius >= ny - 1 or not open_.limit(1).count():
            open_ = None
            break
        inner, radius = radius, min(radius * 3, ny - 1)
    out = done[0].filter("_closed").select("y", "x", F.col("best.cell").alias("cell"))
    for part in done[1:]:
        out = out.unionByName(part.filter("_closed").select("y", "x", F.col("best.cell").alias("cell")))
    if open_ is not None:
        # Wide gaps: a descent through boxes of valid cells costs the same however far away they are.
        number = (F.col("y").cast("long") * nx + F.col("x"))
        space = [c.alias(n) for c, n in zip(unit_xyz(F.col("lat"), F.col("lon")), ("px", "py", "pz"))]
        valid = dense.filter("_ok").join(lat, "y").join(lon, "x").select(number.alias("point"), *space)
        far = nearest_points(open_.select(number.alias("id"), *space), valid)
        out = out.unionByName(far.select(F.expr(f"CAST(id DIV {nx} AS INT)").alias("y"), F.expr(f"CAST(id % {nx} AS INT)").alias("x"), F.col("point").alias("cell")))
    found = materialise(out.select(
        "y", "x", F.expr(f"CAST(cell DIV {nx} AS INT)").alias("src_y"), F.expr(f"CAST(cell % {nx} AS INT)").alias("src_x")
    ))
    discard(dense, cand, *done)
    return found


def apply_mapping(cells: DataFrame, mapping: DataFrame, by: list[str] | None = None, value: str = "value") -> DataFrame:
    """Fill every time and level with one mapping ``(y, x, src_y, src_x)``.

    Only cells to be filled look for their donor, and a donor that serves very many of them does no harm.
    """
    by = by or []
    if not row_count(mapping):
        return cells.select(*by, "y", "x", *[c for c in cells.columns if c not in (*by, "y", "x")])
    donors = cells.select(*by, F.col("y").alias("src_y"), F.col("x").alias("src_x"), F.col(value).alias("_fill"))
    gaps = cells.select(*by, "y", "x").join(F.broadcast(mapping) if is_small(mapping) else mapping, ["y", "x"])
    filled = lookup(gaps, donors, by + ["src_y", "src_x"], "left").select(*by, "y", "x", "_fill", F.lit(True).alias("_mapped"))
    out = cells.join(filled, by + ["y", "x"], "left")
    return out.withColumn(value, F.when(F.col("_mapped"), F.col("_fill")).otherwise(F.col(value))).drop("_fill", "_mapped")


def fill_missing(
    cells: DataFrame, axis_y: DataFrame, axis_x: DataFrame, circular: bool = True, by: list[str] | None = None,
    value: str = "value", target_mask: DataFrame | None = None, search_mask: DataFrame | None = None,
) -> DataFrame:
    """Fill missing cells from their nearest valid neighbour; all slices of `by` share the first slice's mapping.

    `target_mask` ``(y, x, masked)``: masked cells are not filled and end up masked.  `search_mask` ``(y, x, excluded)``:
    excluded cells are not used as donors.
    """
    by = by or []
    first = cells
    if by:
        key = cells.select(*by).orderBy(*by).first()
        for c in by:
            first = first.filter(F.col(c) == key[c])
    wanted = excluded = None
    if target_mask is not None:
        first = first.join(target_mask.select("y", "x", F.col("masked").alias("_tm")), ["y", "x"], "left")
        wanted = ~F.coalesce("_tm", F.lit(False))
    if search_mask is not None:
        first = first.join(search_mask.select("y", "x", F.col("excluded").alias("_sm")), ["y", "x"], "left")
        excluded = F.coalesce("_sm", F.lit(False))
    mapping = nearest_valid(first, axis_y, axis_x, circular, value, wanted, excluded)
    out = apply_mapping(cells, mapping, by, value)
    if target_mask is not None:
        out = out.join(target_mask.select("y", "x", F.col("masked").alias("_tm")), ["y", "x"], "left")
        out = out.withColumn(value, F.when(F.coalesce("_tm", F.lit(False)), F.lit(None)).otherwise(F.col(value))).drop("_tm")
    return out


def mask_faults(mask: DataFrame, flag: str = "land") -> tuple[int, int]:
    """How many cells of a mask are masked, and how many are neither 0 nor 1."""
    v = F.col(flag)
    found = mask.agg(F.count(F.when(v.isNull(), 1)).alias("masked"), F.count(F.when(~v.cast("double").isin(0.0, 1.0), 1)).alias("odd")).first()
    return found["masked"], found["odd"]


def make_consistent(
    cells: DataFrame, mask: DataFrame, axis_y: DataFrame | None = None, axis_x: DataFrame | None = None, invert: bool = False, circular: bool = True,
    by: list[str] | None = None, value: str = "value",
) -> DataFrame:
    """Fill and mask fields so that they have data exactly where the mask ``(y, x, land)`` wants it.

    Without `invert` a mask value of 1 masks the cell; with it, 0 does (fields that live on land).  Fields on a mesh, which have a `face_id`
    and coordinates of their own, take a mask ``(face_id, land)`` and no axes.  Mask cells that are masked, or neither 0 nor 1, are reported
    as a warning.
    """
    masked, odd = mask_faults(mask)
    if masked:
        warnings.warn(f"{masked} cells of the land-sea mask are masked, which may give unexpected results", stacklevel=2)
    if odd:
        warnings.warn(f"{odd} cells of the land-sea mask are neither 0 nor 1, which may give unexpected results", stacklevel=2)
    flag = (F.col("land") == 0) if invert else (F.col("land") != 0)
    if "face_id" in cells.columns:
        return fill_mesh(cells, mask.select("face_id", F.coalesce(flag, F.lit(True)).alias("masked")), by, value)
    target = mask.select("y", "x", F.coalesce(flag, F.lit(True)).alias("masked"))
    return fill_missing(cells, axis_y, axis_x, circular, by, value, target)


# ---- points in space: a bounding-box tree built and descended by joins ------------------------------------------

_SHIFT = 4  # children per axis and level
_BOX = (("px", "x0", "x1"), ("py", "y0", "y1"), ("pz", "z0", "z1"))


def _cube(level: int) -> str:
    """Number of the cube a place lies in along each axis, as SQL."""
    n = _SHIFT**level
    return ", ".join(f"least(CAST(floor(({c} + 1D) / 2D * {n}D) AS BIGINT), {n - 1}L)" for c, _, _ in _BOX)


def _levels(places: DataFrame, leaf_rows: int, max_level: int) -> tuple[DataFrame, int]:
    """Boxes of all occupied cubes ``(lv, k, x0...z1)`` down to the level where no cube holds more than `leaf_rows` places, and that level.

    The places are counted once at the finest level; the coarser ones are rolled up from there.
    """
    tight = [f(c).alias(n) for c, lo, hi in _BOX for f, n in ((F.min, lo), (F.max, hi))]
    wide = [f(n).alias(n) for _, lo, hi in _BOX for f, n in ((F.min, lo), (F.max, hi))]
    finest = places.groupBy(F.expr(f"array({_cube(max_level)})").alias("k")).agg(F.count(F.lit(1)).alias("n"), *tight)
    up = f"transform(sequence(1, {max_level}), lv -> named_struct('lv', lv, 'k', transform(k, v -> shiftright(v, 2 * ({max_level} - lv)))))"
    rolled = finest.withColumn("_u", F.expr(f"explode({up})")).groupBy(F.col("_u.lv").alias("lv"), F.col("_u.k").alias("k"))
    boxes = materialise(rolled.agg(F.sum("n").alias("n"), *wide))
    most = {r["lv"]: r["n"] for r in boxes.groupBy("lv").agg(F.max("n").alias("n")).collect()}  # one row per level
    return boxes, next((lv for lv in sorted(most) if most[lv] <= leaf_rows), max_level)


def nearest_points(queries: DataFrame, points: DataFrame, leaf_rows: int = 64, max_level: int | None = None) -> DataFrame:
    """Exact nearest point ``(id, point, d)`` for queries ``(id, px, py, pz)`` among ``(point, px, py, pz)`` in [-1, 1]^3.

    Space is cut into cubes, each into 64, until no cube holds more than `leaf_rows` distinct places or cubes are as small as the distances
    that count as ties.  Queries descend and keep only cubes whose least distance does not exceed the least greatest distance seen, so
    each query touches a handful of cubes however the points are clustered.  Ties go to the smaller point number.
    """
    places = materialise(points.groupBy("px", "py", "pz").agg(F.min("point").alias("point")))
    n = row_count(places)
    if not n:
        raise ValueError("there is no valid point to take values from")
    if max_level is None:
        # Evenly spread places on a surface need this many levels; six more split clusters 4,096 times as dense along each axis.
        max_level = min(max(math.ceil(math.log(max(n / leaf_rows, 1), 16)) + 6, 2), 15)
    boxes, level = _levels(places, leaf_rows, max_level)

    def near(q, lo, hi):
        return F.greatest(F.col(lo) - F.col(q), F.col(q) - F.col(hi), F.lit(0.0))

    def far(q, lo, hi):
        return F.greatest(F.abs(F.col(lo) - F.col(q)), F.abs(F.col(hi) - F.col(q)))

    lower = F.sqrt(sum((near(*a) * near(*a) for a in _BOX), F.lit(0.0)))
    upper = F.sqrt(sum((far(*a) * far(*a) for a in _BOX), F.lit(0.0)))
    box = F.struct("k", *[c for _, lo, hi in _BOX for c in (lo, hi)])
    whole = F.expr("array(0L, 0L, 0L)")
    live, held = queries.select("id", "px", "py", "pz", whole.alias("k")), []
    margin = 10.0**-TIE_DIGITS
    per_level = {r["lv"]: r["n"] for r in boxes.groupBy("lv").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per level
    parts = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = row_count(queries)
    for lv in range(1, level + 1):
        parent = F.expr("transform(k, v -> shiftright(v, 2))")
        # At most 64 cubes below each cube.
        children = materialise(boxes.filter(F.col("lv") == lv).groupBy(parent.alias("p")).agg(F.collect_list(box).alias("kids")).withColumnRenamed("p", "k"))
        # A broadcast holds the cubes below, so they are what counts.
        size = max(per_level.get(lv, 1), per_level.get(lv - 1, 1))

        def below(rows, *more):
            step = lookup(rows, children, ["k"], at_most=size).select("id", "px", "py", "pz", *more, F.explode("kids").alias("b"))  # noqa: B023
            return step.select("id", "px", "py", "pz", *more, "b.*")

        # The cubes below are gone through twice, for the reach and for what it leaves: no task sorts or holds them.
        reach = below(live).groupBy("id").agg(F.min(upper).alias("reach"))
        live = below(live.repartition(parts, "id").join(small(reach, asked), "id"), "reach").filter(lower <= F.col("reach") + margin).select("id", "px", "py", "pz", "k")
        live = materialise(live)
        held += [live, children]
    leaf = places.select(F.expr(f"array({_cube(level)})").alias("k"), "point", *[F.col(c).alias("q" + c[1]) for c, _, _ in _BOX])
    gaps = [(F.col(p) - F.col(q)) for p, q in (("px", "qx"), ("py", "qy"), ("pz", "qz"))]
    d = F.round(F.sqrt(sum((g * g for g in gaps), F.lit(0.0))), TIE_DIGITS)
    # First the least distance, then the least point at it: numbers are aggregated without sorting the pairs.
    least = live.join(merged(leaf), "k").groupBy("id").agg(F.min(d).alias("d"))
    ties = live.repartition(parts, "id").join(small(least, asked), "id").join(merged(leaf), "k").filter(d == F.col("d"))
    out = materialise(ties.groupBy("id").agg(F.min("point").alias("point"), F.min("d").alias("d")))
    discard(places, boxes, *held)
    return out


def fill_mesh(faces: DataFrame, target_mask: DataFrame | None = None, by: list[str] | None = None, value: str = "value") -> DataFrame:
    """Fill missing mesh faces ``(face_id, lat, lon, value)`` from the nearest valid face in space."""
    by = by or []
    first = faces
    if by:
        key = faces.select(*by).orderBy(*by).first()
        for c in by:
            first = first.filter(F.col(c) == key[c])
    xyz = [c.alias(n) for c, n in zip(unit_xyz(F.col("lat"), F.col("lon")), ("px", "py", "pz"))]
    ok = F.col(value).isNotNull() & ~F.isnan(value)
    missing = first.filter(~ok).select(F.col("face_id").alias("id"), *xyz)
    if target_mask is not None:
        skip = target_mask.filter("masked").select(F.col("face_id").alias("id"))
        missing = missing.join(skip, "id", "left_anti")
    near = nearest_points(missing, first.filter(ok).select(F.col("face_id").alias("point"), *xyz))
    mapping = materialise(near.select(F.col("id").alias("face_id"), F.col("point").alias("src_face")))
    donors = faces.select(*by, F.col("face_id").alias("src_face"), F.col(value).alias("_fill"))
    gaps = faces.select(*by, "face_id").join(small(mapping, row_count(mapping)), "face_id")
    filled = lookup(gaps, donors, by + ["src_face"], "left").select(*by, "face_id", "_fill", F.lit(True).alias("_mapped"))
    out = faces.join(filled, by + ["face_id"], "left")
    out = out.withColumn(value, F.when(F.col("_mapped"), F.col("_fill")).otherwise(F.col(value))).drop("_fill", "_mapped")
    if target_mask is not None:
        flag = target_mask.select("face_id", F.col("masked").alias("_tm"))
        out = out.join(flag, "face_id", "left").withColumn(value, F.when(F.coalesce("_tm", F.lit(False)), F.lit(None)).otherwise(F.col(value))).drop("_tm")
    return out
