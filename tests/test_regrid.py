import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom import session as ss
from gridloom.functions import projection
from gridloom.operators import curved, merge, regrid
from gridloom.sources import axes as ax
from tests.conftest import as_grid, grid_frame, rows

NAN = float("nan")


def test_masked_and_nan_are_kept_apart(spark):
    src = grid_frame(spark, [[1.0, 3.0, None, None], [1.0, 3.0, None, NAN]])
    sy, sx = ax.regular_axis(spark, 2, -10.0, 10.0), ax.regular_axis(spark, 4, 0.0, 10.0)
    ty, tx = ax.regular_axis(spark, 1, -10.0, 20.0), ax.regular_axis(spark, 3, 0.0, 20.0)
    got = as_grid(regrid.area_weighted(src, sy, sx, ty, tx, period=None))[0]
    assert got[0] == pytest.approx(2.0)
    assert math.isnan(got[1])  # a NaN in the source shows
    assert len(got) == 2  # nothing lies under the third cell
    full = regrid.complete(regrid.area_weighted(src.filter("x < 2"), sy, sx, ty, tx, period=None), 1, 3)
    assert rows(full) == [(0, 0, pytest.approx(2.0)), (0, 1, None), (0, 2, None)]


def test_all_masked_is_masked_and_outside_is_nan(spark):
    src = grid_frame(spark, [[None, None, 5.0, 5.0]])
    sy, sx = ax.regular_axis(spark, 1, 0.0, 10.0), ax.regular_axis(spark, 4, 0.0, 10.0)
    ty, tx = ax.regular_axis(spark, 1, 0.0, 10.0), ax.regular_axis(spark, 2, 0.0, 20.0)
    assert as_grid(regrid.area_weighted(src, sy, sx, ty, tx, period=None))[0] == [None, 5.0]
    wide = ax.regular_axis(spark, 2, 25.0, 10.0)
    got = as_grid(regrid.area_weighted(src, sy, sx, ty, wide, period=None))[0]
    assert got[0] == 5.0 and math.isnan(got[1])


def test_wrap_across_the_date_line(spark):
    src = grid_frame(spark, [[1.0, 2.0, 3.0, 4.0]])
    sy, sx = ax.regular_axis(spark, 1, -90.0, 180.0), ax.regular_axis(spark, 4, 0.0, 90.0)
    tx = ax.regular_axis(spark, 4, -45.0, 90.0)
    assert as_grid(regrid.area_weighted(src, sy, sx, sy, tx))[0] == pytest.approx([2.5, 1.5, 2.5, 3.5])


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_result_does_not_depend_on_partitions(spark, partitions):
    rng = np.random.default_rng(3)
    data = rng.random((6, 10)).tolist()
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        src = grid_frame(spark, data).repartition(partitions)
        sy, sx = ax.regular_axis(spark, 6, -90.0, 30.0), ax.regular_axis(spark, 10, -180.0, 36.0)
        ty, tx = ax.regular_axis(spark, 4, -90.0, 45.0), ax.regular_axis(spark, 7, -180.0, 360.0 / 7)
        got = np.array(as_grid(regrid.area_weighted(src, sy, sx, ty, tx)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    want = np.zeros((4, 7))
    for j in range(4):
        for i in range(7):
            num = den = 0.0
            for y in range(6):
                for x in range(10):
                    wx = min(-180 + 36 * (x + 1), -180 + 360 / 7 * (i + 1)) - max(-180 + 36 * x, -180 + 360 / 7 * i)
                    a, b = max(-90 + 30 * y, -90 + 45 * j), min(-60 + 30 * y, -45 + 45 * j)
                    if wx > 1e-9 and b > a:
                        w = wx * (math.sin(math.radians(b)) - math.sin(math.radians(a)))
                        num, den = num + w * data[y][x], den + w
            want[j, i] = num / den
    assert np.allclose(got, want, rtol=1e-10)


def test_bilinear_reproduces_a_plane_and_masks(spark):
    data = [[2.0 * y + 3.0 * x for x in range(5)] for y in range(4)]
    sy, sx = ax.regular_axis(spark, 4, 0.0, 1.0), ax.regular_axis(spark, 5, 0.0, 1.0)
    ty, tx = ax.regular_axis(spark, 3, 0.2, 1.1), ax.regular_axis(spark, 2, 0.7, 1.3)
    got = as_grid(regrid.bilinear(grid_frame(spark, data), sy, sx, ty, tx, mode="linear"))
    want = [[2.0 * (0.2 + 1.1 * (j + 0.5) - 0.5) + 3.0 * (0.7 + 1.3 * (i + 0.5) - 0.5) for i in range(2)] for j in range(3)]
    assert np.allclose(got, want)
    data[1][1] = None
    got = as_grid(regrid.bilinear(grid_frame(spark, data), sy, sx, ty, tx))
    assert got[0][0] is None and got[2][1] is not None


def test_two_stage_between_rotated_systems(spark):
    sy, sx = ax.regular_axis(spark, 36, -90.0, 5.0), ax.regular_axis(spark, 72, -180.0, 5.0)
    lat = [-87.5 + 5 * y for y in range(36)]
    src = grid_frame(spark, [[lat[y]] * 72 for y in range(36)])
    ty, tx = ax.regular_axis(spark, 6, -15.0, 5.0), ax.regular_axis(spark, 6, -15.0, 5.0)
    got = np.array(as_grid(regrid.two_stage(src, sy, sx, ty, tx, tgt_system=(37.5, 177.5))))
    theta = math.radians(37.5)
    for j in range(6):
        for i in range(6):
            phi, lam = math.radians(-12.5 + 5 * j), math.radians(-12.5 + 5 * i)
            want = math.degrees(math.asin(math.sin(phi) * math.sin(theta) + math.cos(phi) * math.cos(lam) * math.cos(theta)))
            assert abs(got[j, i] - want) < 0.5


def test_zonal_source(spark):
    sy, sx = ax.regular_axis(spark, 2, -90.0, 90.0), ax.regular_axis(spark, 1, 0.0, 360.0)
    tx = ax.regular_axis(spark, 5, -180.0, 72.0)
    z = regrid.zonal_target(sx, tx)
    assert ax.facts(z)[0].n == 1
    assert as_grid(regrid.two_stage(grid_frame(spark, [[1.0], [2.0]]), sy, sx, sy, tx)) == [[1.0], [2.0]]
    assert regrid.zonal_target(tx, sx) is sx


def test_unexpected_nan(spark):
    good, bad = grid_frame(spark, [[1.0]]), grid_frame(spark, [[NAN]])
    regrid.unexpected_nan(good, good)
    regrid.unexpected_nan(bad, bad)
    with pytest.raises(ValueError):
        regrid.unexpected_nan(bad, good)


def test_curved_weights_match_the_rectilinear_ones(spark):
    sy, sx = ax.regular_axis(spark, 60, -30.0, 1.0), ax.regular_axis(spark, 60, -30.0, 1.0)
    ty, tx = ax.regular_axis(spark, 7, -21.0, 6.0), ax.regular_axis(spark, 8, -20.0, 5.0)
    a = curved.corners_from_axes(sy, sx, 60, 60)
    b = curved.corners_from_axes(ty, tx, 7, 8)
    got = {(r["src_cell"], r["tgt_cell"]): r["w"] for r in curved.curved_weights(a, b).collect()}
    flat = regrid.rectilinear_weights(sy, sx, ty, tx, None).collect()
    want = {(r["sy"] * 60 + r["sx"], r["ty"] * 8 + r["tx"]): r["w"] for r in flat}
    # Arcs are not parallels, so slivers along the edges differ.
    assert all(abs(got.get(k, 0.0) - w) < 2e-3 for k, w in want.items())
    total = {}
    for (_, t), w in got.items():
        total[t] = total.get(t, 0.0) + w
    assert len(total) == 56 and all(abs(v - 1.0) < 1e-9 for v in total.values())


def test_curved_weights_of_turned_cells(spark):
    square = [("a", [-1.0, -1.0, 1.0, 1.0], [-1.0, 1.0, 1.0, -1.0]), ("far", [50.0, 50.0, 51.0, 51.0], [0.0, 1.0, 1.0, 0.0])]
    diamond = [("d", [0.0, -1.0, 0.0, 1.0], [-1.0, 0.0, 1.0, 0.0])]
    s = spark.createDataFrame(square, "cell STRING, lats ARRAY<DOUBLE>, lons ARRAY<DOUBLE>")
    t = spark.createDataFrame(diamond, "cell STRING, lats ARRAY<DOUBLE>, lons ARRAY<DOUBLE>")
    assert rows(curved.curved_weights(s, t)) == [("a", "d", pytest.approx(1.0, abs=1e-9))]
    back = rows(curved.curved_weights(t, s))
    assert back == [("d", "a", pytest.approx(0.5, abs=1e-4))]
    mixed = spark.createDataFrame([("m", [1.0, -1.0, 1.0, -1.0], [1.0, -1.0, -1.0, 1.0])], "cell STRING, lats ARRAY<DOUBLE>, lons ARRAY<DOUBLE>")
    assert rows(curved.curved_weights(curved.corners_from_bounds(mixed), t)) == [("m", "d", pytest.approx(1.0, abs=1e-9))]


def _cells(spark, *outlines):
    return spark.createDataFrame([(n, [float(a) for a, _ in c], [float(o) for _, o in c]) for n, c in outlines], "cell STRING, lats ARRAY<DOUBLE>, lons ARRAY<DOUBLE>")


def test_weights_of_cells_that_are_not_convex(spark):
    """Octants and their thirds have closed-form areas; an L and an arrow are made of convex cells whose areas are known apart."""
    square = lambda y, x, n=1: [(y, x), (y, x + n), (y + n, x + n), (y + n, x)]
    ell = [(0, 0), (0, 2), (1, 2), (1, 1), (2, 1), (2, 0)]
    quads = [("a", square(0, 0)), ("b", square(0, 1)), ("c", square(1, 0)), ("gap", square(1, 1))]
    sizes = {n: float(np.abs(curved.spherical_area(_space(c)[None]))[0]) for n, c in quads}
    total = sizes["a"] + sizes["b"] + sizes["c"]
    outlines = {"L": ell, "back": ell[::-1], "later": ell[3:] + ell[:3]}
    got = {(r["src_cell"], r["tgt_cell"]): r["w"] for r in curved.curved_weights(_cells(spark, *quads), _cells(spark, *outlines.items())).collect()}
    assert got == {(n, o): pytest.approx(sizes[n] / total, abs=1e-9) for n in "abc" for o in outlines}
    back = {(r["src_cell"], r["tgt_cell"]): r["w"] for r in curved.curved_weights(_cells(spark, *outlines.items()), _cells(spark, *quads)).collect()}
    assert back == {(o, n): pytest.approx(1.0, abs=1e-9) for n in "abc" for o in outlines}
    # An octant less the third of it around one corner's arc: (2/3) of pi / 2.
    octant = [(0, 0), (0, 90), (90, 0)]
    middle = float(np.degrees(np.arctan(np.sqrt(0.5))))
    dart = [(0, 0), (0, 90), (90, 0), (middle, 45)]
    got = rows(curved.curved_weights(_cells(spark, ("dart", dart)), _cells(spark, ("octant", octant))))
    assert got == [("dart", "octant", pytest.approx(2 / 3, abs=1e-9))]


def _space(corners):
    a, o = np.radians(np.array(corners, float)).T
    return np.stack([np.cos(a) * np.cos(o), np.cos(a) * np.sin(o), np.sin(a)], axis=-1)


def test_weights_of_cells_around_a_pole(spark):
    """A cap of n corners has n times the area of the triangle from the pole, by its spherical excess; its corners come in any order."""
    cap = [(80, 60 * k - 170) for k in range(6)]
    ring = [[(70, 60 * k - 170), (70, 60 * k - 110), (80, 60 * k - 110), (80, 60 * k - 170)] for k in range(6)]
    shuffled = _cells(spark, ("cap", [cap[i] for i in (3, 0, 5, 1, 4, 2)]))
    t2 = np.tan(np.radians(10) / 2) ** 2
    want = 6 * 2 * np.arctan2(t2 * np.sin(np.pi / 3), 1 + t2 * np.cos(np.pi / 3))
    quarters = _cells(spark, *[(str(k), [(0, 90 * k), (0, 90 * k + 90), (90, 0)]) for k in range(4)])
    got = {r["src_cell"]: r["w"] for r in curved.curved_weights(quarters, curved.corners_from_bounds(shuffled)).collect()}
    assert sum(got.values()) == pytest.approx(1.0, abs=1e-9) and len(got) == 4
    share = rows(curved.curved_weights(curved.corners_from_bounds(shuffled), quarters), "w")
    assert sum(w for w, in share) * np.pi / 2 == pytest.approx(want, rel=1e-9)
    # The cap with a notch: a corner drawn in to the pole leaves four of six triangles.
    notched = cap[:2] + [(90, 0)] + cap[3:]
    cut = rows(curved.curved_weights(_cells(spark, ("notch", notched)), curved.corners_from_bounds(shuffled)))
    assert cut == [("notch", "cap", pytest.approx(4 / 6, abs=1e-9))]
    assert rows(curved.curved_weights(_cells(spark, *[(str(k), c) for k, c in enumerate(ring)]), curved.corners_from_bounds(shuffled))) == []
    assert curved.ears(_space(cap)[None]).shape == (1, 4, 3)


def test_ears_of_many_outlines():
    """Triangles of random star-shaped outlines fill them, whatever the outline's turns, straight and repeated corners."""
    rng = np.random.default_rng(3)
    for n in (4, 5, 8, 13):
        angle = np.sort(rng.uniform(0, 2 * np.pi, (40, n)), axis=1)
        far = rng.uniform(0.01, 0.2, (40, n))
        p = np.stack([far * np.cos(angle), far * np.sin(angle), np.ones((40, n))], axis=-1)
        p[:5, 1] = p[:5, 0]
        p[5:10, 1] = (p[5:10, 0] + p[5:10, 2]) / 2
        p /= np.linalg.norm(p, axis=-1, keepdims=True)
        parts = np.take_along_axis(p[:, None], curved.ears(p)[..., None], axis=2)
        areas = curved.spherical_area(parts.reshape(-1, 3, 3)).reshape(40, -1)
        simple = np.abs(np.diff(np.c_[angle, angle[:, :1] + 2 * np.pi], axis=1)).max(axis=1) < np.pi
        assert simple.any() and (areas[simple] > -1e-12).all()
        assert np.allclose(areas.sum(axis=1)[simple], curved.spherical_area(p)[simple], atol=1e-12)


def test_weights_mask_what_they_touch(spark):
    cells = spark.createDataFrame([(0, 1.0), (1, None), (2, 5.0)], "src_cell INT, value DOUBLE")
    w = spark.createDataFrame([(0, 0, 0.5), (2, 0, 0.25), (1, 1, 0.5), (2, 1, 0.5)], "src_cell INT, tgt_cell INT, w DOUBLE")
    assert rows(regrid.apply_weights(cells, w)) == [(0, 1.75), (1, None)]
    assert rows(regrid.apply_weights(cells, w, normalise=True, digits=12)) == [(0, round(1.75 / 0.75, 12)), (1, None)]


def plane(spark, y_points, x_points, f):
    return grid_frame(spark, [[f(a, o) for o in x_points] for a in y_points])


def axis_of(spark, edges):
    return spark.createDataFrame([(i, (a + b) / 2, a, b) for i, (a, b) in enumerate(zip(edges, edges[1:]))], "idx INT, point DOUBLE, lo DOUBLE, hi DOUBLE")


def test_scattered_points_between_uneven_axes(spark):
    ys, xs = [-0.5, 0.5, 1.5, 4.0, 8.0], [-0.5, 0.5, 1.5, 6.0, 15.0, 25.0, 35.0]
    y, x = axis_of(spark, ys), axis_of(spark, xs)
    pts = spark.createDataFrame([(0, 0, 1.0, 5.0), (0, 1, 5.0, 25.0), (0, 2, 0.0, 0.0), (0, 3, 7.0, 5.0)], "_ty INT, _tx INT, _lat DOUBLE, _lon DOUBLE")
    w = regrid.scattered_linear_weights(pts, y, x, 360.0)
    mid = [(a + b) / 2 for a, b in zip(xs, xs[1:])]
    lat = [(a + b) / 2 for a, b in zip(ys, ys[1:])]
    got = {}
    for r in w.collect():
        a = got.setdefault(r["_tx"], [0.0, 0.0, r["_inside"]])
        a[0] += r["_w"] * lat[r["y"]]
        a[1] += r["_w"] * mid[r["x"]]
    assert got[0] == [pytest.approx(1.0), pytest.approx(5.0), True] and got[1][:2] == [pytest.approx(5.0), pytest.approx(25.0)] and got[3][2] is False


def test_the_intermediate_grid_follows_the_cropped_source(spark):
    y, x = ax.regular_axis(spark, 36, -90.0, 5.0), ax.regular_axis(spark, 72, -180.0, 5.0)
    ty, tx = ax.regular_axis(spark, 4, -10.0, 5.0), ax.regular_axis(spark, 4, -10.0, 5.0)
    cy, cx = regrid.overlap_axes(y, x, ty, tx, None, (37.5, 177.5), 360.0)
    f_y, f_x = ax.facts(cy, cx)
    assert f_y.n < 10 and f_x.n < 14 and f_y.lo <= 42.5 and f_y.hi >= 62.5
    pole_y, pole_x = regrid.overlap_axes(y, x, ax.regular_axis(spark, 8, 20.0, 5.0), tx, None, (37.5, 177.5), 360.0)
    assert ax.facts(pole_y)[0].hi == 90.0 and ax.facts(pole_x)[0].n == 72  # holds the pole, so all around
    date_y, date_x = regrid.overlap_axes(y, x, ax.regular_axis(spark, 2, -5.0, 5.0), ax.regular_axis(spark, 4, 170.0, 5.0), None, (89.0, 180.0), 360.0)
    f = ax.facts(date_x)[0]
    assert f.n < 72 and f.lo < 180 < f.hi and f.hi - f.lo == pytest.approx(5.0 * f.n)


def test_british_grid_there_and_back(spark):
    p = spark.createDataFrame([(0, 651409.903, 313177.270), (1, 400000.0, -100000.0), (2, 10.0, 1200000.0)], "id INT, e DOUBLE, n DOUBLE")
    lat, lon = projection.from_british_grid(F.col("e"), F.col("n"))
    q = p.select("id", "e", "n", lat.alias("lat"), lon.alias("lon"))
    first = q.filter("id = 0").first()
    # The worked example of the grid's own guide: 52 39 27.2531 N, 1 43 4.5177 E.
    assert abs(first["lat"] - (52 + 39 / 60 + 27.2531 / 3600)) < 1e-7 and abs(first["lon"] - (1 + 43 / 60 + 4.5177 / 3600)) < 1e-7
    e, n = projection.to_british_grid(F.col("lat"), F.col("lon"))
    assert all(abs(r[0] - r[1]) < 0.01 and abs(r[2] - r[3]) < 0.01 for r in q.select("e", e, "n", n).collect())


def test_to_a_mesh(spark):
    """Faces of a mesh that are the cells of a coarser grid: the means of what they cover, and a zonal source is split."""
    y, x = ax.regular_axis(spark, 36, -90.0, 5.0), ax.regular_axis(spark, 72, -180.0, 5.0)
    nodes = spark.createDataFrame([(j * 13 + i, -80.0 + 40 * j, -180.0 + 30 * i) for j in range(5) for i in range(13)], "node_id INT, lat DOUBLE, lon DOUBLE")
    faces = spark.createDataFrame([(100 + j * 12 + i, [j * 13 + i + 1, j * 13 + i + 2, j * 13 + i + 15, j * 13 + i + 14]) for j in range(4) for i in range(12)], "face_id LONG, nodes ARRAY<INT>")
    src = grid_frame(spark, [[float(i // 6) for i in range(72)] for _ in range(36)])
    got = {r["face_id"]: r["value"] for r in regrid.to_mesh(src, y, x, faces, nodes).collect()}
    assert len(got) == 48 and all(abs(v - (f - 100) % 12) < 1e-6 for f, v in got.items())
    zonal = grid_frame(spark, [[float(j)] for j in range(36)])
    column = ax.regular_axis(spark, 1, -180.0, 360.0)
    rows_ = {r["face_id"]: r["value"] for r in regrid.to_mesh(zonal, y, column, faces, nodes).collect()}
    assert len(rows_) == 48 and max(rows_[f] for f in range(100, 112)) < min(rows_[f] for f in range(136, 148))


def test_curved_candidates_grow_with_the_cells(spark):
    def pairs(ny, nx):
        fine = curved.corners_from_axes(ax.regular_axis(spark, ny, -90.0, 180.0 / ny), ax.regular_axis(spark, nx, -180.0, 360.0 / nx), ny, nx)
        coarse = curved.corners_from_axes(ax.regular_axis(spark, 6, -90.0, 30.0), ax.regular_axis(spark, 9, -180.0, 40.0), 6, 9)
        return fine, coarse

    fine, coarse = pairs(30, 60)
    w = curved.curved_weights(fine, coarse)
    assert all(abs(r["s"] - 1) < 1e-9 for r in w.groupBy("tgt_cell").agg(F.sum("w").alias("s")).collect())
    small_n, large_n = (curved.candidate_pairs(*pairs(*n)).count() for n in ((20, 40), (40, 80)))
    assert large_n < 5 * small_n


def test_polygons_by_plain_loops(spark):
    rng = np.random.default_rng(6)
    y, x = ax.regular_axis(spark, 20, -10.0, 1.0), ax.regular_axis(spark, 30, -15.0, 1.0)
    polys = {}
    for k in range(6):
        angle = np.sort(rng.uniform(0, 2 * np.pi, 7))
        size = rng.uniform(1, 8, 7)
        polys[str(k)] = [(round(float(4 * (k - 3) + r * np.cos(a)), 0 if k % 2 else 3), round(float(r * np.sin(a)), 0 if k % 2 else 3)) for a, r in zip(angle, size)]
    vertices = spark.createDataFrame([(p, i, *v) for p, c in polys.items() for i, v in enumerate(c)], "poly STRING, seq INT, px DOUBLE, py DOUBLE")

    def strictly(px, py, c):
        odd = touch = False
        for (x1, y1), (x2, y2) in zip(c, c[1:] + c[:1]):
            if (x1, y1) == (x2, y2) or not min(y1, y2) <= py <= max(y1, y2):
                continue
            if y1 == y2:
                touch |= min(x1, x2) <= px <= max(x1, x2)
                continue
            at = x1 + (py - y1) / (y2 - y1) * (x2 - x1)
            touch |= at == px
            odd ^= (y1 > py) != (y2 > py) and at > px
        return odd and not touch

    cells = spark.range(600).selectExpr("CAST(id DIV 30 AS INT) AS y", "CAST(id % 30 AS INT) AS x")
    for corners in (True, False):
        got = {(r["y"], r["x"]): r["inside"] for r in merge.inside_polygons(cells, merge.polygon_edges(vertices), y, x, corners).collect()}
        for (j, i), v in got.items():
            places = [(-15 + i + a, -10 + j + b) for a in (0, 1) for b in (0, 1)] if corners else [(-14.5 + i, -9.5 + j)]
            assert v == any(strictly(px, py, c) for px, py in places for c in polys.values()), (j, i)


def test_small_cells_are_shuffled_for_larger_classes_only(spark, monkeypatch):
    """Cells much smaller than all targets meet them in the targets' cubes: about a row each, not one per cube of their own size as well."""
    ay, ax_ = ax.regular_axis(spark, 60, -30.0, 1.0), ax.regular_axis(spark, 60, -30.0, 1.0)
    ty, tx = ax.regular_axis(spark, 2, -30.0, 30.0), ax.regular_axis(spark, 2, -30.0, 30.0)
    counted = []
    plain = curved.materialise

    def seen(df):
        # Fine cells are grouped by cube to find crowded ones; what is grouped are the rows that will be shuffled.
        if df.columns == ["level", "cx", "cy", "cz", "n"]:
            counted.append(df)
        return plain(df)

    monkeypatch.setattr(curved, "materialise", seen)
    monkeypatch.setattr(curved, "HOT_SHARE", 10**9)
    real = max
    monkeypatch.setattr(curved, "max", lambda *a: 0 if a[1:] == (10_000,) else real(*a), raising=False)
    w = curved.curved_weights(curved.corners_from_axes(ay, ax_, 60, 60), curved.corners_from_axes(ty, tx, 2, 2))
    total = {r.tgt_cell: r.w for r in w.groupBy("tgt_cell").agg(F.sum("w").alias("w")).collect()}
    assert len(total) == 4 and all(abs(v - 1) < 0.02 for v in total.values())
    levels = {r.level: r.n for r in counted[0].groupBy("level").agg(F.sum("n").alias("n")).collect()}
    assert len(levels) == 1 and sum(levels.values()) < 2 * 3600


def test_tasks_that_clip_hold_a_share_of_the_cells(spark, monkeypatch):
    """Cells are dealt out to be clipped, and their overlaps to be summed, by their number, not by the session's number of partitions."""
    monkeypatch.setattr(ss, "TASK_ROWS", 400)
    ay, ax_ = ax.regular_axis(spark, 20, -20.0, 2.0), ax.regular_axis(spark, 20, -20.0, 2.0)
    quads = curved.corners_from_axes(ay, ax_, 20, 20)
    ells = spark.range(25).selectExpr("id AS cell", "CAST(-20 + 8 * (id DIV 5) AS DOUBLE) AS s", "CAST(-20 + 8 * (id % 5) AS DOUBLE) AS w").selectExpr(
        "cell", "array(s, s, s, s + 4, s + 4, s + 8, s + 8) AS lats", "array(w, w + 4, w + 8, w + 8, w + 4, w + 4, w) AS lons")
    written = []
    plain = curved.materialise

    def seen(df):
        out = plain(df)
        if "_part" in df.columns:
            sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
            written.append((max(sizes), sum(sizes), out.filter("w = 0").count()))
        return out

    monkeypatch.setattr(curved, "materialise", seen)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        w = curved.curved_weights(quads, ells)
        sizes = [r["count"] for r in w.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        total = {r.tgt_cell: r.w for r in w.groupBy("tgt_cell").agg(F.sum("w").alias("w")).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(total) == 25 and all(abs(v - 1) < 0.02 for v in total.values())
    (most, pairs, nothing), = written
    assert nothing == 0 and most < pairs / 2.5 and max(sizes) < sum(sizes) / 2


def test_cells_lie_in_few_cubes_and_leave_few_tables(spark, monkeypatch):
    dealt, real = [], curved.within_tasks
    monkeypatch.setattr(curved, "within_tasks", lambda df, rows, *keys: dealt.append(rows) or real(df, rows, *keys))
    axis, beside = ax.regular_axis(spark, 40, 0.0, 0.5), ax.regular_axis(spark, 20, 5.25, 0.5)
    src = curved.corners_from_axes(axis, axis, 40, 40)
    bent = spark.range(9).selectExpr("id AS cell", "array(0D, 0D, 0D, 1D, 1D, 2D, 2D) AS lats", "array(0D, 1D, 2D, 2D, 1D, 1D, 0D) AS lons").selectExpr("cell", "transform(lats, v -> v + 2 * (cell DIV 3)) AS lats", "transform(lons, v -> v + 2 * (cell % 3)) AS lons")
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    bent_w = {r["tgt_cell"]: (r["n"], r["w"]) for r in curved.curved_weights(src, bent).groupBy("tgt_cell").agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("w")).collect()}
    # Each bent cell holds three squares of four cells; of what was written only the weights and the counts of cubes are left.
    assert len(bent_w) == 9 and all(n >= 12 and abs(w - 1) < 1e-9 for n, w in bent_w.values())
    assert len(set(os.listdir(folder)) - before) <= 2
    dealt.clear()
    sums = curved.curved_weights(src, curved.corners_from_axes(beside, beside, 20, 20)).groupBy("tgt_cell").agg(F.sum("w").alias("w")).collect()
    assert len(sums) == 400 and all(abs(r["w"] - 1) < 1e-9 for r in sums)
    assert 1600 <= dealt[0] < 2 * 1600
