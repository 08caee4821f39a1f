"""Neighbourhood operators.

Rectangular neighbourhoods are separable sums: a sliding sum along each row, then along each column.  A field is shuffled
twice and never blown up by the window's size.  Only neighbourhood patterns with holes scatter their (few) matching cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.columns import EARTH_RADIUS
from gridloom.session import small
from gridloom.sources.axes import facts

# Flow direction code -> row and column step, rows counted downwards from the north.
FLOW_STEPS = {1: (-1, 0), 2: (-1, 1), 3: (0, 1), 4: (1, 1), 5: (1, 0), 6: (1, -1), 7: (0, -1), 8: (-1, -1)}


def halo(cells: DataFrame, nx: int, width: int) -> DataFrame:
    """Repeat the first and last `width` columns beyond the other side, marked by ``_ghost``."""
    shifts = F.filter(
        F.array(
            F.lit(0),
            F.when(F.col("x") < width, F.lit(nx)),
            F.when(F.col("x") >= nx - width, F.lit(-nx)),
        ),
        lambda s: s.isNotNull(),
    )
    out = cells.withColumn("_shift", F.explode(shifts))
    return out.withColumn("x", F.col("x") + F.col("_shift")).withColumn("_ghost", F.col("_shift") != 0).drop("_shift")


def moore_sums(
    cells: DataFrame,
    sums: dict[str, Column],
    nx: int,
    circular: bool = True,
    half: tuple[int, int] = (1, 1),
    centre: bool = False,
    by: list[str] | None = None,
) -> DataFrame:
    """Sum each expression over the neighbours within `half` = (rows, columns); NULL expressions count as zero.

    `centre` includes the cell itself.  Cells beyond the edge (or beyond the poles)
    do not exist; every other cell must be a row, see `regrid.complete`.
    """
    by = by or []
    hy, hx = half
    base = cells
    for name, expr in sums.items():
        base = base.withColumn("_v_" + name, F.coalesce(expr.cast("double"), F.lit(0.0)))
    wide = halo(base, nx, hx) if circular else base.withColumn("_ghost", F.lit(False))
    row = Window.partitionBy(*by, "y").orderBy("x").rangeBetween(-hx, hx)
    for name in sums:
        wide = wide.withColumn("_r_" + name, F.sum("_v_" + name).over(row))
    wide = wide.filter(~F.col("_ghost")).drop("_ghost")
    col = Window.partitionBy(*by, "x").orderBy("y").rangeBetween(-hy, hy)
    for name in sums:
        total = F.sum("_r_" + name).over(col)
        wide = wide.withColumn(name, total if centre else total - F.col("_v_" + name))
    return wide.drop(*[c for n in sums for c in ("_v_" + n, "_r_" + n)])


def neighbourhood(
    cells: DataFrame, nx: int, circular: bool = True, value: str = "value", equal_to: float | None = None,
    half: tuple[int, int] = (1, 1), centre: bool = False, by: list[str] | None = None,
) -> DataFrame:
    """Counts and mean of the neighbourhood: ``n_valid, all_missing, any_present, mean`` and tests against `equal_to`.

    The grid must be dense (masked cells present as NULL).  Missing neighbours agree with any value in `all_equal`.
    """
    v = F.col(value)
    sums = {"n_valid": v.isNotNull().cast("int"), "_s": v}
    if equal_to is not None:
        sums["_eq"] = (v == equal_to).cast("int")
    out = moore_sums(cells, sums, nx, circular, half, centre, by)
    out = (
        out.withColumn("n_valid", F.round("n_valid").cast("int"))
        .withColumn("all_missing", F.col("n_valid") == 0)
        .withColumn("any_present", F.col("n_valid") > 0)
        .withColumn("mean", F.when(F.col("n_valid") > 0, F.col("_s") / F.col("n_valid")))
    )
    if equal_to is not None:
        eq = F.round("_eq").cast("int")
        out = out.withColumn("all_equal", eq == F.col("n_valid")).withColumn("any_equal", eq > 0)
    return out.drop("_s", "_eq")


def any_equal_pattern(
    cells: DataFrame, pattern: dict[tuple[int, int], float], nx: int, circular: bool = True, value: str = "value",
    by: list[str] | None = None,
) -> DataFrame:
    """Cells for which some neighbour at offset (dy, dx) has the value `pattern` asks for there, as `any_equal`.

    Only cells that can match are sent to the positions they would satisfy, and are de-duplicated before meeting the grid.
    """
    by = by or []
    targets = [
        F.when(F.col(value) == want, F.struct((F.col("y") - dy).alias("y"), (F.col("x") - dx).alias("x")))
        for (dy, dx), want in pattern.items()
    ]
    hits = cells.withColumn("_t", F.explode(F.filter(F.array(*targets), lambda t: t.isNotNull())))
    x = F.pmod("_t.x", F.lit(nx)) if circular else F.col("_t.x")
    hits = hits.select(*by, F.col("_t.y").alias("y"), x.cast("int").alias("x")).distinct().withColumn("_hit", F.lit(True))
    return cells.join(hits, by + ["y", "x"], "left").withColumn("any_equal", F.coalesce("_hit", F.lit(False))).drop("_hit")


def flow_in(directions: DataFrame, ny: int, nx: int, code: str = "code", north_up: bool = False) -> DataFrame:
    """Does any neighbour's direction code point at the cell?  Both axes wrap.

    Rows count downwards from the north; with `north_up` they count upwards.
    """
    sign = -1 if north_up else 1
    dy = F.lit(None).cast("int")
    dx = F.lit(None).cast("int")
    for c, (sy, sx) in FLOW_STEPS.items():
        dy = F.when(F.col(code) == c, F.lit(sign * sy)).otherwise(dy)
        dx = F.when(F.col(code) == c, F.lit(sx)).otherwise(dx)
    down = directions.select((F.col("y") + dy).alias("_y"), (F.col("x") + dx).alias("_x")).filter("_y IS NOT NULL")
    down = down.select(
        F.pmod("_y", F.lit(ny)).cast("int").alias("y"), F.pmod("_x", F.lit(nx)).cast("int").alias("x")
    ).distinct().withColumn("_in", F.lit(True))
    return directions.join(down, ["y", "x"], "left").withColumn("flow_in", F.coalesce("_in", F.lit(False))).drop("_in")


def coastal_fill(
    cells: DataFrame, land: str, nx: int, circular: bool = True, default: float | None = None, value: str = "value",
) -> DataFrame:
    """Make a dense field agree with a land flag: sea is masked, land without data takes its neighbours' mean.

    Land with no data around takes `default`, or the mean of all land values including the ones just filled.
    """
    v = F.when(F.col(land) == 0, F.lit(None).cast("double")).otherwise(F.col(value))
    base = cells.withColumn(value, v)
    hood = neighbourhood(base, nx, circular, value)
    gap = (F.col(land) == 1) & F.col(value).isNull()
    out = hood.withColumn("_gap", gap).withColumn(value, F.when(gap, F.col("mean")).otherwise(F.col(value)))
    if default is None:
        default = out.agg(F.avg(value)).first()[0]
    filled = F.when(F.col("_gap") & F.col("all_missing"), F.lit(default)).otherwise(F.col(value))
    return out.withColumn(value, filled).drop("_gap", "n_valid", "all_missing", "any_present", "mean")


def _slope(part: list[str], index: str, pos: str, value: str, n: int, wrap: float | None) -> Column:
    """Gradient at cell points along one axis: adjacent differences interpolated from mid-points back to points.

    At open ends the two nearest mid-points are extrapolated.  With `wrap` the axis closes after that distance.
    """
    w = Window.partitionBy(*part).orderBy(index)

    def at(k: int) -> tuple[Column, Column]:
        p, v = (F.lag(pos, -k).over(w), F.lag(value, -k).over(w)) if k < 0 else (F.lead(pos, k).over(w), F.lead(value, k).over(w))
        return (F.col(pos), F.col(value)) if k == 0 else (p, v)

    def diff(k: int) -> tuple[Column, Column]:
        (p0, v0), (p1, v1) = at(k), at(k + 1)
        return (p0 + p1) / 2, (v1 - v0) / (p1 - p0)

    def line(a, b):
        (ma, da), (mb, db) = a, b
        return da + (F.col(pos) - ma) / (mb - ma) * (db - da)

    inner = line(diff(-1), diff(0))
    if wrap is not None:
        return inner
    first, last = F.col(index) == 0, F.col(index) == n - 1
    return F.when(first, line(diff(0), diff(1))).when(last, line(diff(-2), diff(-1))).otherwise(inner)


def gradients(
    cells: DataFrame, axis_y: DataFrame, axis_x: DataFrame, circular: bool = True, value: str = "value",
    radius: float = EARTH_RADIUS, by: list[str] | None = None,
) -> DataFrame:
    """dh/dx and dh/dy of a dense field at cell points, per metre."""
    by = by or []
    ny, nx = (f.n for f in facts(axis_y, axis_x))
    lat = axis_y.select(F.col("idx").alias("y"), F.radians("point").alias("_lat"))
    lon = axis_x.select(F.col("idx").alias("x"), F.radians("point").alias("_lon"))
    base = cells.join(small(lat, ny), "y").join(small(lon, nx), "x")
    if circular:
        turn = 2 * 3.141592653589793
        base = halo(base, nx, 1).withColumn(
            "_lon", F.when(F.col("x") < 0, F.col("_lon") - turn).when(F.col("x") >= nx, F.col("_lon") + turn).otherwise(F.col("_lon"))
        )
    scale = F.lit(radius) * F.cos("_lat")
    out = base.withColumn("dhdx", _slope(by + ["y"], "x", "_lon", value, nx, 360.0 if circular else None) / scale)
    if circular:
        out = out.filter(~F.col("_ghost")).drop("_ghost")
    out = out.withColumn("dhdy", _slope(by + ["x"], "y", "_lat", value, ny, None) / F.lit(radius))
    return out.drop("_lat", "_lon")
