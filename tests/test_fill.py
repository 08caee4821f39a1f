import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import fill
from gridloom.sources import axes as ax
from tests.conftest import as_grid, grid_frame, rows

NAN = float("nan")


def brute(lat, lon, value, donors):
    """Nearest donor per missing cell; ties within nine decimals go to the smaller cell."""
    def xyz(a, o):
        a, o = math.radians(a), math.radians(o)
        return np.array([math.cos(a) * math.cos(o), math.cos(a) * math.sin(o), math.sin(a)])

    out = [list(r) for r in value]
    nx = len(lon)
    for y in range(len(lat)):
        for x in range(nx):
            v = value[y][x]
            if v is None or math.isnan(v):
                best = min((round(float(np.linalg.norm(xyz(lat[y], lon[x]) - xyz(lat[b], lon[a]))), 9), b * nx + a) for b, a in donors)
                out[y][x] = value[best[1] // nx][best[1] % nx]
    return out


@pytest.mark.parametrize("seed,share", [(1, 0.3), (2, 0.95), (3, 0.995)])
def test_grid_fill_is_exact(spark, seed, share):
    rng = np.random.default_rng(seed)
    ny, nx = 18, 24
    value = [[None if rng.random() < share else round(float(rng.random()), 3) for _ in range(nx)] for _ in range(ny)]
    value[4][7], value[0][0] = 9.0, NAN
    y, x = ax.regular_axis(spark, ny, -90.0, 10.0), ax.regular_axis(spark, nx, -180.0, 15.0)
    donors = [(b, a) for b in range(ny) for a in range(nx) if value[b][a] is not None and not math.isnan(value[b][a])]
    want = brute([-85 + 10 * i for i in range(ny)], [-172.5 + 15 * i for i in range(nx)], value, donors)
    got = as_grid(fill.fill_missing(grid_frame(spark, value), y, x))
    assert got == want


def test_wide_gaps_are_searched_through_boxes(spark, monkeypatch):
    monkeypatch.setattr(fill, "NEAR_ROWS", 1)
    test_grid_fill_is_exact(spark, 3, 0.995)
    test_grid_fill_is_exact(spark, 2, 0.95)


def test_points_denser_than_any_grid(spark):
    """A cluster far finer than the levels that evenly spread points would need."""
    rng = np.random.default_rng(9)
    pts = np.vstack([rng.uniform(-1, 1, (50, 3)), 0.25 + rng.uniform(0, 1e-6, (300, 3))])
    p = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(pts)], "point LONG, px DOUBLE, py DOUBLE, pz DOUBLE")
    q = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(pts[::3])], "id LONG, px DOUBLE, py DOUBLE, pz DOUBLE")
    for r in fill.nearest_points(q, p, leaf_rows=8).collect():
        d = np.round(np.linalg.norm(pts - pts[3 * r["id"]], axis=1), 9)
        assert r["point"] == int(np.flatnonzero(d == d.min())[0])


def test_odd_masks_are_reported_and_meshes_are_filled(spark):
    y, x = ax.regular_axis(spark, 1, 0.0, 10.0), ax.regular_axis(spark, 4, 0.0, 10.0)
    f = grid_frame(spark, [[1.0, None, 3.0, 4.0]])
    with pytest.warns(UserWarning) as seen:
        got = fill.make_consistent(f, grid_frame(spark, [[0, 0, None, 2]], "land", "INT"), y, x, circular=False)
    assert [str(w.message)[:7] for w in seen if w.category is UserWarning] == ["1 cells", "1 cells"] and as_grid(got) == [[1.0, 1.0, None, None]]
    faces = spark.createDataFrame([(0, 0.0, 0.0, 1.0), (1, 0.0, 10.0, None), (2, 0.0, 20.0, 3.0)], "face_id LONG, lat DOUBLE, lon DOUBLE, value DOUBLE")
    mask = spark.createDataFrame([(0, 1), (1, 1), (2, 0)], "face_id LONG, land INT")
    assert rows(fill.make_consistent(faces, mask, invert=True), "face_id", "value") == [(0, 1.0), (1, 1.0), (2, None)]


def test_one_mapping_serves_all_slices_and_masks_are_inherited(spark):
    y, x = ax.regular_axis(spark, 1, 0.0, 10.0), ax.regular_axis(spark, 4, 0.0, 10.0)
    one = grid_frame(spark, [[1.0, None, None, 4.0]])
    both = one.withColumn("t", F.lit(0)).unionByName(one.withColumn("t", F.lit(1)).withColumn("value", F.col("value") * 10))
    mask = grid_frame(spark, [[False, False, True, True]], "masked", "BOOLEAN")
    got = fill.fill_missing(both, y, x, circular=False, by=["t"], target_mask=mask)
    assert rows(got, "t", "x", "value") == [(0, 0, 1.0), (0, 1, 1.0), (0, 2, None), (0, 3, None), (1, 0, 10.0), (1, 1, 10.0), (1, 2, None), (1, 3, None)]


def test_wrap_only_when_circular(spark):
    y, x = ax.regular_axis(spark, 1, 0.0, 10.0), ax.regular_axis(spark, 6, 0.0, 60.0)
    f = grid_frame(spark, [[None, None, 2.0, 3.0, 4.0, 5.0]])
    assert as_grid(fill.fill_missing(f, y, x, circular=True))[0][0] == 5.0
    narrow = ax.regular_axis(spark, 6, 0.0, 10.0)
    assert as_grid(fill.fill_missing(f, y, narrow, circular=False))[0][:2] == [2.0, 2.0]


def test_nothing_to_fill_and_nothing_to_fill_from(spark):
    y, x = ax.regular_axis(spark, 1, 0.0, 10.0), ax.regular_axis(spark, 2, 0.0, 10.0)
    assert as_grid(fill.fill_missing(grid_frame(spark, [[1.0, 2.0]]), y, x)) == [[1.0, 2.0]]
    with pytest.raises(ValueError):
        fill.fill_missing(grid_frame(spark, [[None, None]]), y, x)


@pytest.mark.parametrize("leaf", [2, 64])
def test_nearest_points_with_a_dense_cluster(spark, leaf):
    rng = np.random.default_rng(5)
    cluster = rng.normal(0.3, 1e-4, (400, 3))
    spread = rng.uniform(-1, 1, (300, 3))
    pts = np.clip(np.vstack([cluster, spread, cluster[:5]]), -1, 1)
    qs = np.clip(np.vstack([rng.normal(0.3, 1e-4, (60, 3)), rng.uniform(-1, 1, (60, 3))]), -1, 1)
    p = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(pts)], "point LONG, px DOUBLE, py DOUBLE, pz DOUBLE")
    q = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(qs)], "id LONG, px DOUBLE, py DOUBLE, pz DOUBLE")
    got = {r["id"]: r["point"] for r in fill.nearest_points(q, p, leaf_rows=leaf, max_level=8).collect()}
    for i, v in enumerate(qs):
        d = np.round(np.linalg.norm(pts - v, axis=1), 9)
        assert got[i] == int(np.flatnonzero(d == d.min())[0])


def test_mesh_fill_with_mask(spark):
    faces = spark.createDataFrame(
        [(0, 0.0, 0.0, 1.0), (1, 0.0, 10.0, None), (2, 0.0, 170.0, 3.0), (3, 0.0, -175.0, NAN), (4, 89.0, 0.0, None)],
        "face_id LONG, lat DOUBLE, lon DOUBLE, value DOUBLE",
    )
    mask = spark.createDataFrame([(i, i in (2, 4)) for i in range(5)], "face_id LONG, masked BOOLEAN")
    assert rows(fill.fill_mesh(faces, mask), "face_id", "value") == [(0, 1.0), (1, 1.0), (2, None), (3, 3.0), (4, None)]


def test_a_descent_sorts_and_shuffles_no_children(spark, monkeypatch):
    rng = np.random.default_rng(8)
    places, asked = rng.uniform(-1, 1, (3000, 3)), rng.uniform(-1, 1, (200, 3))
    places[2000:] = places[:1000]
    frames = [spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(a)], f"{n} LONG, px DOUBLE, py DOUBLE, pz DOUBLE") for n, a in (("point", places), ("id", asked))]
    plans, cut = [], fill.materialise
    monkeypatch.setattr(fill, "materialise", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df))
    got = fill.nearest_points(frames[1], frames[0], leaf_rows=8)
    d = np.round(np.sqrt(((asked[:, None] - places[None]) ** 2).sum(axis=2)), 9)
    assert {r["id"]: r["point"] for r in got.collect()} == dict(enumerate(d.argmin(axis=1).tolist()))
    assert not any("Window" in p for p in plans)
    assert "SortAggregate" not in plans[-1]


def test_long_rows_take_time_in_proportion(spark):
    """A row of 80,000 cells with a donor in every 40th: its cells are gone through once to each side."""
    n = 80_000
    y, x = ax.regular_axis(spark, 1, -90.0, 180.0), ax.regular_axis(spark, n, -180.0, 360.0 / n)
    cells = spark.range(n).selectExpr("0 AS y", "CAST(id AS INT) AS x", "IF(id % 40 = 0, CAST(id AS DOUBLE), NULL) AS value")
    start = time.monotonic()
    got = [r.value for r in fill.fill_missing(cells, y, x).orderBy("x").collect()]
    assert time.monotonic() - start < 20
    # Half way between two donors the smaller cell number wins, around the globe as well.
    assert got == [min((abs(i - d), d % n) for d in (i // 40 * 40, i // 40 * 40 + 40))[1] for i in range(n)]
