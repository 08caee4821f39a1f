"""Conservative weights between cells with curved or rotated outlines, as polygons of great-circle arcs.

Cells may be of any simple outline smaller than a hemisphere, a pole inside included.  Those that are not convex are cut into triangles first;
only convex pieces are clipped, and the pieces' overlaps are added up per pair of cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.session import HOT_SHARE, discard, materialise, row_count, small, within_tasks

#: A cell is put into cubes this many powers of two larger than itself, where they are no larger than 2 ** COARSEST.  Every cube is a row with the
#: cell's corners to be shuffled: a cell of a quarter of a cube's side lies in one or two cubes, one of the whole side in four.
SPARE, COARSEST = 2, -4


def corners_from_axes(axis_y: DataFrame, axis_x: DataFrame, ny: int, nx: int, cell: str = "cell") -> DataFrame:
    """Cells ``(cell, lats, lons)`` with four corners, counter-clockwise, from two axis tables."""
    spark = axis_y.sparkSession
    cells = spark.range(ny * nx).selectExpr(f"id AS {cell}", f"CAST(id DIV {nx} AS INT) AS _y", f"CAST(id % {nx} AS INT) AS _x")
    ya = axis_y.selectExpr("idx AS _y", "least(lo, hi) AS _a", "greatest(lo, hi) AS _b")
    xa = axis_x.selectExpr("idx AS _x", "least(lo, hi) AS _c", "greatest(lo, hi) AS _d")
    out = cells.join(small(ya, ny), "_y").join(small(xa, nx), "_x")
    return out.selectExpr(cell, "array(_a, _a, _b, _b) AS lats", "array(_c, _d, _d, _c) AS lons")


def corners_from_bounds(cells: DataFrame, cell: str = "cell") -> DataFrame:
    """Cells with corner arrays given in any vertex order, sorted counter-clockwise around the cell's centre.

    Corners are sorted in the plane that touches the sphere at their mean direction, so cells across the date line and around a pole stay
    whole.  Cells that are not convex must be given with their corners in order, since an outline is not told by its corners then.
    """
    c = cells.selectExpr(cell, "lats", "lons", f"{_XYZ} AS v")
    c = c.selectExpr("*", *[f"aggregate(v, 0D, (s, q) -> s + q.{a}) AS m{a}" for a in "xyz"])
    c = materialise(c).selectExpr(cell, "lats", "lons", "v", *[f"m{a} / sqrt(mx * mx + my * my + mz * mz) AS c{a}" for a in "xyz"])
    # East of the first corner's direction from the centre counts as the first angle.
    c = c.selectExpr("*", "v[0].x * cx + v[0].y * cy + v[0].z * cz AS d0")
    c = materialise(c.selectExpr("*", *[f"v[0].{a} - d0 * c{a} AS e{a}" for a in "xyz"]))
    side = "cx * (ey * q.z - ez * q.y) + cy * (ez * q.x - ex * q.z) + cz * (ex * q.y - ey * q.x)"
    angle = f"pmod(atan2({side}, ex * q.x + ey * q.y + ez * q.z) + 1e-12D, 2D * pi())"
    c = c.selectExpr(cell, f"array_sort(transform(v, (q, i) -> struct({angle} AS a, lats[i] AS lat, lons[i] AS lon))) AS p")
    return c.selectExpr(cell, "transform(p, q -> q.lat) AS lats", "transform(p, q -> q.lon) AS lons")


_XYZ = "zip_with(lats, lons, (a, o) -> struct(cos(radians(a)) * cos(radians(o)) AS x, cos(radians(a)) * sin(radians(o)) AS y, sin(radians(a)) AS z))"
#: Signed volume under three neighbouring corners: over zero at a left turn.
_TURN = (
    "transform(sequence(1, size(v)), k -> aggregate(array(struct(v[k - 1] AS a, v[k % size(v)] AS b, v[(k + 1) % size(v)] AS c)), 0D, (s, t) -> "
    "t.a.x * (t.b.y * t.c.z - t.b.z * t.c.y) + t.a.y * (t.b.z * t.c.x - t.b.x * t.c.z) + t.a.z * (t.b.x * t.c.y - t.b.y * t.c.x)))"
)
#: Turns this small come from rounding or from repeated corners.
_STRAIGHT = 1e-14


def ears(p: np.ndarray) -> np.ndarray:
    """Corners (rows, triangles, 3) of the triangles that counter-clockwise polygons (rows, corners, 3) are made of, all rows at once.

    A corner is cut off where the outline turns left and no other corner lies in the triangle with its neighbours; corners on a straight
    line are dropped as triangles without area.
    """
    rows, n = p.shape[:2]
    left = np.tile(np.arange(n), (rows, 1))
    out = np.empty((rows, n - 2, 3), int)
    every = np.arange(rows)

    def at(i):
        return np.take_along_axis(p, i[..., None], axis=1)

    def turn(a, b, c):
        return (a * np.cross(b, c)).sum(-1)

    for k in range(n - 2):
        before, after = np.roll(left, 1, axis=1), np.roll(left, -1, axis=1)
        a, b, c = at(before), at(left), at(after)
        bend = turn(a, b, c)
        q = at(left)[:, None]
        inside = np.minimum(np.minimum(turn(a[:, :, None], b[:, :, None], q), turn(b[:, :, None], c[:, :, None], q)), turn(c[:, :, None], a[:, :, None], q)) > -_STRAIGHT
        same = (q == a[:, :, None]).all(-1) | (q == b[:, :, None]).all(-1) | (q == c[:, :, None]).all(-1)
        clear = ~(inside & ~same).any(-1)
        # A straight corner goes first, then any ear; an outline that crosses itself has none and loses its sharpest corner.
        rank = np.where(np.abs(bend) <= _STRAIGHT, 3.0, np.where((bend > 0) & clear, 2.0, 0.0)) + np.clip(bend, -0.5, 0.5)
        best = rank.argmax(axis=1)
        out[:, k] = np.stack([before[every, best], left[every, best], after[every, best]], axis=1)
        left = left[np.arange(left.shape[1])[None, :] != best[:, None]].reshape(rows, -1)
    return out


def _triangles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cells ``(id, v)`` as their triangles, with the area of the whole cell."""
    for pdf in batches:
        sizes = pdf["v"].map(len)
        for _, some in pdf.groupby(sizes):
            p = _polygons(some["v"])
            corners = np.take_along_axis(p[:, None], ears(p)[..., None], axis=2)
            area = np.abs(spherical_area(corners.reshape(-1, 3, 3))).reshape(len(p), -1)
            cell, piece = np.nonzero(area > 0)
            yield pd.DataFrame({
                "id": some["id"].to_numpy()[cell], "v": list(corners[cell, piece].reshape(len(cell), 9)), "whole": area.sum(axis=1)[cell],
            })


def convex_pieces(cells: DataFrame, cell: str = "cell") -> DataFrame:
    """``(cell, v, whole)``: convex cells as they are, others as triangles with the area of the cell; `v` are corners in space."""
    return _pieces(cells, cell)[0]


def _pieces(cells: DataFrame, cell: str) -> tuple[DataFrame, DataFrame]:
    """`convex_pieces`, and the table that they are read from."""
    # Written first: a filter on the turns would be pushed below and work the corners out again for every turn.
    corners = materialise(cells.selectExpr(f"`{cell}` AS id", f"{_XYZ} AS v"))
    convex = f"forall(_turns, t -> t >= -{_STRAIGHT}D) OR forall(_turns, t -> t <= {_STRAIGHT}D) AS _convex"
    c = materialise(corners.selectExpr("*", f"{_TURN} AS _turns").selectExpr("id", "v", convex))
    discard(corners)
    whole = c.filter("_convex").selectExpr("id", "v", "CAST(NULL AS DOUBLE) AS whole")
    kind = dict(cells.dtypes)[cell]
    flat = c.filter("NOT _convex").selectExpr("id", "flatten(transform(v, q -> array(q.x, q.y, q.z))) AS v")
    cut = flat.mapInPandas(_triangles, f"id {kind}, v ARRAY<DOUBLE>, whole DOUBLE")
    corner = "transform(sequence(0, 2), i -> struct(v[3 * i] AS x, v[3 * i + 1] AS y, v[3 * i + 2] AS z)) AS v"
    return whole.unionByName(cut.selectExpr("id", corner, "whole")).withColumnRenamed("id", cell), c


def _boxed(cells: DataFrame, cell: str, prefix: str) -> DataFrame:
    """Table of the bounding box in space of each cell's convex pieces, widened by how far an arc of the piece's size can bulge."""
    pieces, held = _pieces(cells, cell)
    c = pieces.selectExpr(f"{cell} AS {prefix}", "v", "whole")
    c = c.selectExpr(
        "*", *[f"array_min(transform(v, q -> q.{a})) AS l{a}" for a in "xyz"], *[f"array_max(transform(v, q -> q.{a})) AS h{a}" for a in "xyz"],
    )
    c = c.selectExpr("*", "0.5D * (pow(hx - lx, 2) + pow(hy - ly, 2) + pow(hz - lz, 2)) + 1e-12D AS pad")
    out = materialise(c.selectExpr(
        prefix, f"v AS {prefix}_v", f"whole AS {prefix}_whole", *[f"l{a} - pad AS {prefix}_l{a}" for a in "xyz"], *[f"h{a} + pad AS {prefix}_h{a}" for a in "xyz"],
    ))
    discard(held)
    return out


def candidate_pairs(src: DataFrame, tgt: DataFrame, cell: str = "cell") -> DataFrame:
    """Pairs of cells whose boxes overlap, met by equality in cubes of the larger one's size class: ``(s, t, s_v, t_v, s_whole, t_whole)``.

    A cell that is not convex takes part with each of its triangles; `s_whole` and `t_whole` are its area, null for convex cells.

    Cubes come in powers of two, up to four times a cell's size.  A cell is put into the cubes, eight at most, of the larger classes that the other side has and, where the
    other side has cells of its own size class or smaller ones, of its own, so there are a few rows per cell whatever the ratio of the two resolutions.  A pair counts in the
    first cube both share.  Cubes that hold more than a thousandth of the source cells are salted.
    """
    return _meet(_boxed(src, cell, "s"), _boxed(tgt, cell, "t"))


def _meet(s: DataFrame, t: DataFrame) -> DataFrame:
    """`candidate_pairs` of cells that `_boxed` has prepared."""
    n = row_count(s)
    own_size = "CAST(greatest(ceil(log2(greatest({p}_hx - {p}_lx, {p}_hy - {p}_ly, {p}_hz - {p}_lz, 1e-9D))), -30) AS INT)"
    size = f"least({own_size} + {SPARE}, greatest({own_size}, {COARSEST}))"
    classes = {p: sorted(r[0] for r in df.select(F.expr(size.format(p=p))).distinct().collect()) for p, df in (("s", s), ("t", t))}  # some thirty at most

    cube = "CAST(floor({p}_{e}{a} / pow(2D, level)) AS BIGINT)"

    def cubed(df: DataFrame, p: str, others: list[int]) -> DataFrame:
        """A row per cube, at every larger class of the other side, and at the cell's own class if the other side has cells of it or smaller ones."""
        larger = f"array({', '.join(map(str, others))})" if others else "CAST(array() AS ARRAY<INT>)"
        # Pairs meet at the larger cell's class, so its own cubes are of no use to a cell that is smaller than all others.
        own = f"IF(_own >= {others[0]}, array(_own), array())" if others else "array()"
        df = df.withColumn("_own", F.expr(size.format(p=p)))
        df = df.withColumn("level", F.expr(f"explode(concat({own}, filter({larger}, c -> c > _own)))"))
        for a in "xyz":
            df = df.selectExpr("*", f"explode(sequence({cube.format(p=p, e='l', a=a)}, {cube.format(p=p, e='h', a=a)})) AS c{a}")
        return df.withColumnRenamed("_own", f"{p}_own")

    # These rows are shuffled, one per cube: corners travel as plain numbers, and a cell's first cube is worked out again after the join.
    flat = "flatten(transform({p}_v, q -> array(q.x, q.y, q.z)))"
    s, t = (df.withColumn(f"{p}_v", F.expr(flat.format(p=p))) for p, df in (("s", s), ("t", t)))
    cubes = ["level", "cx", "cy", "cz"]
    sc, tc = cubed(s, "s", classes["t"]), cubed(t, "t", classes["s"])
    limit = max(n // HOT_SHARE, 10_000)
    # Cells lie in as many cubes as their shapes make them; tasks follow the rows.
    n_s, n_t = sc.count(), tc.count()
    counts = materialise(within_tasks(sc.select(*cubes), n_s, *cubes).groupBy(*cubes).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit))
    salts = 32
    # A cell lies in few cubes, so there are not many more hot ones than HOT_SHARE.
    hot = F.broadcast(counts.select(*cubes, F.lit(salts).alias("_salts"))) if row_count(counts) <= 64 * HOT_SHARE else counts.select(*cubes, F.lit(salts).alias("_salts"))
    sc = sc.join(hot, cubes, "left").withColumn("_salt", F.pmod(F.xxhash64("s"), F.coalesce("_salts", F.lit(1))).cast("int")).drop("_salts")
    tc = tc.join(hot, cubes, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    # A row meets all of its cube, so tasks get half the rows that others do.
    sc, tc = (within_tasks(df, 2 * (n_s + n_t), *cubes, "_salt") for df in (sc, tc))
    # Few pairs pass the boxes; only for these the first cube is worked out.
    j = sc.join(tc, cubes + ["_salt"]).filter("level = greatest(s_own, t_own) AND " + " AND ".join(f"s_l{a} <= t_h{a} AND t_l{a} <= s_h{a}" for a in "xyz"))
    for a in "xyz":
        first = ", ".join(cube.format(p=p, e="l", a=a) for p in "st")
        j = j.filter(f"c{a} = greatest({first})")
    return j.selectExpr("s", "t", "s_v", "t_v", "s_whole", "t_whole")


def _polygons(column: pd.Series) -> np.ndarray:
    """Corners given as flat numbers, as (rows, corners, 3); short cells padded with their last corner, turned counter-clockwise."""
    parts = column.to_list()
    corners = np.concatenate(parts).reshape(-1, 3)
    count = np.array([len(p) for p in parts]) // 3
    first = np.cumsum(count) - count
    out = corners[first[:, None] + np.minimum(np.arange(count.max())[None, :], count[:, None] - 1)]
    flip = spherical_area(out) < 0
    out[flip] = out[flip][:, ::-1]
    return out


def spherical_area(p: np.ndarray) -> np.ndarray:
    """Signed area on the unit sphere of polygons (rows, corners, 3), by a fan of triangles."""
    a, b, c = p[:, :1], p[:, 1:-1], p[:, 2:]
    triple = (a * np.cross(b, c)).sum(-1)
    dots = 1.0 + (a * b).sum(-1) + (b * c).sum(-1) + (c * a).sum(-1)
    return 2.0 * np.arctan2(triple, dots).sum(1)


def clip(subject: np.ndarray, window: np.ndarray) -> np.ndarray:
    """Cut convex polygons by the sides of others; what is outside collapses to points without area."""
    p = subject
    room = subject.shape[1] + window.shape[1]
    for k in range(window.shape[1]):
        normal = np.cross(window[:, k], window[:, (k + 1) % window.shape[1]])
        d = (p * normal[:, None]).sum(-1)
        nxt, dn = np.roll(p, -1, axis=1), np.roll(d, -1, axis=1)
        cross = (d * dn) < 0
        cut = p * np.abs(dn)[..., None] + nxt * np.abs(d)[..., None]
        cut /= np.maximum(np.linalg.norm(cut, axis=-1, keepdims=True), 1e-300)
        points = np.stack([cut, nxt], axis=2).reshape(len(p), -1, 3)
        # Sides of no length come from repeated corners; dropping them keeps every polygon within `room` corners.
        fresh = (p != nxt).any(-1)
        valid = np.stack([cross, (dn >= 0) & fresh], axis=2).reshape(len(p), -1)
        order = np.argsort(~valid, axis=1, kind="stable")[:, :room]
        points = np.take_along_axis(points, order[..., None], axis=1)
        valid = np.take_along_axis(valid, order, axis=1)
        # Unused places repeat the first corner; polygons wholly outside shrink to one point.
        p = np.where(valid[..., None], points, points[:, :1])
    return p


def curved_weights(src: DataFrame, tgt: DataFrame, cell: str = "cell") -> DataFrame:
    """Weights ``(src_cell, tgt_cell, w)``: share of each target cell's area covered by each source cell.

    Cells ``(cell, lats, lons)`` have their corners in order, either way round, and no arc of half the globe or more.  Pairs are found by joins;
    each batch of pairs is clipped at once.  Overlaps of the triangles of one pair are added up.
    """

    def overlap(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                a, b = _polygons(pdf["s_v"]), _polygons(pdf["t_v"])
                area = np.abs(spherical_area(clip(a, b)))
                whole = pdf["t_whole"].to_numpy(float, na_value=np.nan)
                share = area / np.where(np.isnan(whole), np.abs(spherical_area(b)), whole)
                out = pd.DataFrame({"src_cell": pdf["s"], "tgt_cell": pdf["t"], "w": share, "_part": ~(np.isnan(whole) & pdf["s_whole"].isna().to_numpy())})
                # Most boxes meet where the pieces do not.
                yield out[share != 0]

    kind = dict(src.dtypes)[cell]
    s, t = _boxed(src, cell, "s"), _boxed(tgt, cell, "t")
    out = _meet(s, t).mapInPandas(overlap, f"src_cell {kind}, tgt_cell {dict(tgt.dtypes)[cell]}, w DOUBLE, _part BOOLEAN")
    # Only pairs with triangles have several rows; the others are not shuffled.
    if any(cells.filter(f"{p}_whole IS NOT NULL").limit(1).count() for p, cells in (("s", s), ("t", t))):
        out = materialise(out)
        discard(s, t)
        n = row_count(out)
        parts = within_tasks(out.filter("_part"), n, "src_cell", "tgt_cell").groupBy("src_cell", "tgt_cell").agg(F.sum("w").alias("w"))
        # Weights meet the source next, as many to a task.
        out = within_tasks(out.filter("NOT _part").drop("_part").unionByName(parts), n, "src_cell")
    return out.select("src_cell", "tgt_cell", "w").filter("w > 1e-12")
