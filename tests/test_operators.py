import math
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from gridloom.functions.legends import flag_table, legend
from gridloom.operators import check, classes, filters, gases, merge, stencil, tiles, timeaxis, vertical
from gridloom.sources import axes as ax
from gridloom.sources import fields
from tests.conftest import as_grid, grid_frame, rows

NAN = float("nan")
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_neighbourhood_against_shifts(spark):
    rng = np.random.default_rng(2)
    data = [[None if rng.random() < 0.3 else float(rng.integers(0, 3)) for _ in range(8)] for _ in range(6)]
    for circular, half in ((True, (1, 1)), (False, (2, 1)), (True, (2, 2))):
        got = stencil.neighbourhood(grid_frame(spark, data), 8, circular, equal_to=1.0, half=half).collect()
        for r in got:
            near = []
            for dy in range(-half[0], half[0] + 1):
                for dx in range(-half[1], half[1] + 1):
                    y, x = r["y"] + dy, r["x"] + dx
                    x = x % 8 if circular else x
                    if (dy or dx) and 0 <= y < 6 and 0 <= x < 8 and data[y][x] is not None:
                        near.append(data[y][x])
            assert r["n_valid"] == len(near) and r["all_missing"] == (not near)
            assert r["all_equal"] == all(v == 1 for v in near) and r["any_equal"] == any(v == 1 for v in near)
            assert (r["mean"] is None and not near) or r["mean"] == pytest.approx(sum(near) / len(near))


def test_gradients_of_uneven_axes(spark):
    lat, lon = [0.0, 10.0, 30.0, 35.0], [0.0, 5.0, 20.0, 50.0, 60.0]
    h = [[2.0 * math.radians(a) ** 2 + 3.0 * math.radians(o) for o in lon] for a in lat]
    y = spark.createDataFrame(list(enumerate(lat)), "idx INT, point DOUBLE")
    x = spark.createDataFrame(list(enumerate(lon)), "idx INT, point DOUBLE")
    got = stencil.gradients(grid_frame(spark, h), y, x, circular=False, radius=1.0)
    for r in got.collect():
        assert r["dhdx"] == pytest.approx(3.0 / math.cos(math.radians(lat[r["y"]])))
        assert r["dhdy"] == pytest.approx(4.0 * math.radians(lat[r["y"]]), abs=1e-9)  # linear slopes are exact


@pytest.mark.parametrize("periodic", [False, True])
def test_filter_against_dense_matrices(spark, periodic):
    rng = np.random.default_rng(6)
    ny, nx, eps = 9, 12, 4.2
    data = rng.random((ny, nx))

    def dense(n, closed):
        a, b = np.zeros((n, n)), np.zeros((n, n))
        for i in range(n):
            order = 3 if closed else min(i, n - 1 - i, 3)
            if not order:
                a[i, i] = 1
                continue
            c = [math.comb(2 * order, k) for k in range(2 * order + 1)]
            for k in range(-order, order + 1):
                a[i, (i + k) % n] += c[k + order] * (1 - eps if k % 2 else 1 + eps)
                b[i, (i + k) % n] += c[k + order] * (eps if k % 2 else -eps)
        return np.eye(n) + np.linalg.solve(a, b)

    want = dense(ny, False) @ (data @ dense(nx, periodic).T)
    old = filters.GROUP_CELLS
    try:
        for size in (old, 30):
            filters.GROUP_CELLS = size
            got = np.array(as_grid(filters.raymond_filter(grid_frame(spark, data.tolist()), ny, nx, eps, circular=periodic)))
            assert np.allclose(got, want, atol=1e-6)
    finally:
        filters.GROUP_CELLS = old
    assert np.allclose(filters.filter_lines(np.full((1, 20), 3.0), np.array([eps]), periodic), 3.0)


def test_filter_strengths(spark):
    lats = spark.createDataFrame([(-90.0,), (0.0,), (60.0,)], "lat DOUBLE")
    got = [r[0] for r in lats.select(filters.strength_by_latitude(1e6, F.col("lat"), 2.0, 1.0)).collect()]
    base = filters.strength_from_length(1e6, 2.0)
    cells = 180.0 * 1e6 / (math.pi * 6371229.0 * 2.0)
    assert got[0] == pytest.approx(base)
    assert got[1] == pytest.approx(1 / math.tan(math.pi / (cells / 2.0)) ** 6)
    assert got[2] == pytest.approx(base)
    rows_ = spark.range(4).select(filters.strength_isotropic(10.0, F.col("id"), 4, 8)).collect()
    assert rows_[0][0] == pytest.approx(rows_[3][0]) and rows_[0][0] > rows_[1][0]


def test_vertical_masks_and_single_levels(spark):
    f = spark.createDataFrame([(0, 0, 1.0, 10.0), (0, 0, 2.0, None), (0, 0, 3.0, 30.0), (0, 1, 5.0, 7.0)], "y INT, x INT, height DOUBLE, value DOUBLE")
    got = vertical.relevel(f, [1.0, 1.5, 3.0, 9.0], ["y", "x"])
    assert rows(got, "x", "level", "value") == [(0, 0, 10.0), (0, 1, None), (0, 2, 30.0), (0, 3, 30.0), (1, 0, 7.0), (1, 1, 7.0), (1, 2, 7.0), (1, 3, 7.0)]
    out = vertical.relevel(f, [0.0, 9.0], ["y", "x"], extrapolation="nan")
    assert all(math.isnan(r["value"]) for r in out.collect())
    layers = f.filter("x = 0").withColumn("z_lo", F.col("height") - 0.5).withColumn("z_hi", F.col("height") + 0.5)
    assert rows(vertical.relevel_conservative(layers, [(0.5, 3.5), (1.5, 2.5), (2.0, 2.75)], ["y", "x"]), "level", "value") == [(0, 20.0), (1, None), (2, 30.0)]
    with pytest.raises(ValueError):
        vertical.relevel(f, [1.0], ["y", "x"], method="cubic")


def test_fractions_keep_masks_and_nan(spark):
    f = spark.createDataFrame(
        [(0, 0, 0, 0.7), (0, 0, 9, 0.5), (0, 1, 0, NAN), (0, 1, 9, NAN), (0, 2, 0, None), (0, 2, 9, None), (0, 3, 0, 0.0), (0, 3, 9, -1.0)], "y INT, x INT, pl INT, value DOUBLE"
    )
    got = {(r["x"], r["pl"]): r["value"] for r in classes.normalise(f).collect()}
    assert got[0, 0] == pytest.approx(0.7 / 1.2) and math.isnan(got[1, 0]) and got[2, 9] is None and got[3, 9] == 0.0
    ice = {(r["x"], r["pl"]): r["value"] for r in classes.whole_fraction_ice(f).collect()}
    assert (ice[0, 0], ice[0, 9]) == (0.0, 1.0) and math.isnan(ice[1, 9]) and ice[2, 0] is None
    dry = classes.remove_ocean(f)
    assert rows(classes.land_mask(dry)) == [(0, 0, 0), (0, 1, None), (0, 2, 0), (0, 3, 1)]


def test_crosswalk_guards(spark):
    walk = spark.createDataFrame([("a", 1, 100), ("b", 1, 100)], "source_type STRING, target_type INT, pct INT")
    flags = spark.createDataFrame([(4, "A"), (6, "B")], "flag_value INT, flag_meaning STRING")
    assert rows(classes.match_flags(walk, flags)) == [(4, 1, 100), (6, 1, 100)]
    with pytest.raises(ValueError):
        classes.match_flags(walk, flags.filter("flag_value = 4"))
    with pytest.raises(ValueError):
        classes.class_levels(spark.createDataFrame([(0, 0, 3, 1.0)], "y INT, x INT, pl INT, value DOUBLE"), [3, 4])
    with pytest.raises(ValueError):
        classes.split_grass(spark.createDataFrame([(0, 0, 4, 1.0)], "y INT, x INT, pl INT, value DOUBLE"), grid_frame(spark, [[1.0]]))
    with pytest.raises(ValueError):
        flag_table(spark.createDataFrame([([1.0], "a b")], "flag_values ARRAY<DOUBLE>, flag_meanings STRING")).count()
    assert {n: legend(spark, n).count() for n in ("cci", "igbp", "ite")} == {"cci": 39, "igbp": 18, "ite": 25}


def test_merge_rules(spark):
    cells = "lat DOUBLE, lon DOUBLE, value DOUBLE, ok BOOLEAN"
    p = spark.createDataFrame([(0.0, 0.0, 1.0, True), (0.0, 1.0, None, True), (0.0, 2.0, NAN, True), (0.0, 3.0, 4.0, False), (0.0, 4.0, 5.0, False)], cells)
    a = spark.createDataFrame([(0.0, 1e-12 + i, 10.0 + i, True) for i in range(4)] + [(1.0, 0.0, None, True)], cells)
    got = merge.merge(p, a, valid="ok")
    assert rows(got) == sorted([(0.0, 0.0, 1.0), (0.0, 1.0, None), (0.0, 2.0, 12.0), (0.0, 3.0, 13.0), (0.0, 4.0, 5.0), (1.0, 0.0, None)], key=repr)
    with pytest.raises(ValueError):
        merge.merge(p, a.filter("lon < 2"), valid="ok")


def test_strictly_inside(spark):
    square = spark.createDataFrame([("s", i, x, y) for i, (x, y) in enumerate([(1.0, 1.0), (3.0, 1.0), (3.0, 3.0), (1.0, 3.0)])], "poly STRING, seq INT, px DOUBLE, py DOUBLE")
    y, x = ax.regular_axis(spark, 4, 0.0, 1.0), ax.regular_axis(spark, 4, 0.0, 1.0)
    got = as_grid(merge.inside_polygons(grid_frame(spark, [[1.0] * 4] * 4), merge.polygon_edges(square), y, x), "inside")
    # Only the node (2, 2) is strictly inside, so the four cells around it are.
    assert got == [[False] * 4, [False, True, True, False], [False, True, True, False], [False] * 4]
    mid = as_grid(merge.inside_polygons(grid_frame(spark, [[1.0] * 4] * 4), merge.polygon_edges(square), y, x, corners=False), "inside")
    assert mid == got


def test_pairs_and_parts_are_checked(spark):
    cat = spark.createDataFrame([(1, 30, "a"), (2, None, "b")], "field_id INT, stash INT, name STRING")
    alt = spark.createDataFrame([(7, 30, "z"), (8, None, "b"), (9, 31, "c")], "field_id INT, stash INT, name STRING")
    assert rows(merge.pair_fields(cat, alt)) == [(1, 7, "30"), (2, 8, "b")]
    with pytest.raises(ValueError):
        merge.pair_fields(cat, alt.filter("field_id <> 8"))
    with pytest.raises(ValueError):
        merge.pair_fields(cat, alt.unionByName(alt))
    with pytest.raises(ValueError):
        merge.concatenate([cat, cat], ["field_id"])


def total(pdf: pd.DataFrame) -> pd.DataFrame:
    s = pdf.set_index(["y", "x"])["value"]
    own = pdf[pdf["_own"]]
    v = sum(s.reindex(pd.MultiIndex.from_arrays([own["y"] + dy, own["x"] + dx])).fillna(0).to_numpy() for dy in (-2, 0, 2) for dx in (-1, 0, 1))
    return pd.DataFrame({"y": own["y"], "x": own["x"], "value": v})


@pytest.mark.parametrize("tile", [None, (7, 11), (4, 4), (2, 3), (1, 1), (3, 5)])
def test_tiling_does_not_show(spark, tile):
    rng = np.random.default_rng(8)
    data = rng.integers(0, 9, (7, 11)).astype(float)
    want = sum(np.roll(np.pad(data, ((2, 2), (0, 0)))[2 + dy: 9 + dy], -dx, axis=1) for dy in (-2, 0, 2) for dx in (-1, 0, 1))
    got = tiles.apply_tiled(grid_frame(spark, data.tolist()), total, "y INT, x INT, value DOUBLE", 7, 11, tile, halo=2)
    assert (np.array(as_grid(got)) == want).all()


def test_tiles_hold_no_more_than_their_budget():
    for ny, nx, cells in ((7, 11, 5), (1000, 2000, 250_000), (10, 10**7, 100_000), (10**6, 3, 1000), (1, 1, 10)):
        sy, sx = tiles.tile_shape(ny, nx, cells)
        assert 1 <= sy <= ny and 1 <= sx <= nx and sy * sx <= cells


def test_merge_on_cells_is_the_merge_on_places(spark):
    p = grid_frame(spark, [[1.0, NAN, None]]).withColumn("inside", F.col("x") < 2)
    a = grid_frame(spark, [[7.0, 8.0, 9.0], [1.0, 2.0, None]])
    on_cells = merge.merge(p, a, valid="inside", place=("y", "x"), exact=True)
    on_places = merge.merge(*[f.withColumnRenamed("y", "lat").withColumnRenamed("x", "lon") for f in (p, a)], valid="inside")
    assert rows(on_cells, "y", "x", "value") == [(0, 0, 1.0), (0, 1, 8.0), (0, 2, 9.0), (1, 0, 1.0), (1, 1, 2.0), (1, 2, None)]
    assert rows(on_places, "lat", "lon", "value") == [(float(y), float(x), v) for y, x, v in rows(on_cells, "y", "x", "value")]


def test_parts_of_a_grid_must_agree(spark):
    y, x = ax.regular_axis(spark, 2, 0.0, 1.0), ax.regular_axis(spark, 3, 0.0, 1.0)
    levels = spark.createDataFrame([(k, float(k), 0.0) for k in range(12_000)], "level INT, height DOUBLE, sigma DOUBLE")
    assert fields.load_grid(y, x, levels, others=[(y, None), (None, ax.regular_axis(spark, 3, 0.0, 1.0))]).count() == 6 * 12_000
    for other in ((ax.regular_axis(spark, 2, 0.5, 1.0), None), (None, ax.regular_axis(spark, 4, 0.0, 1.0))):
        with pytest.raises(ValueError, match="differs"):
            fields.load_grid(y, x, others=[(y, x), other])


def test_padding_reads_its_input_once(spark):
    f = spark.createDataFrame([(yr, m, 0, float(yr)) for yr in range(2000, 2004) for m in (1, 2)], "year INT, month INT, x INT, value DOUBLE")
    got = timeaxis.pad_ends(f, [], 1999, 2004, 2000, 2003, repeat_last=2)
    assert rows(got, "year", "month", "days", "value") == [
        (yr, m, 30 * (2 * i + m - 1) + 15, float(v)) for i, (yr, v) in enumerate([(1999, 2000), (2000, 2000), (2001, 2001), (2002, 2002), (2003, 2003), (2004, 2003)]) for m in (1, 2)]


def test_compare_treats_nan_and_null_as_values(spark):
    a = grid_frame(spark, [[1.0, None, NAN, 2.0]])
    b = grid_frame(spark, [[1.0, None, NAN, None]])
    assert rows(check.compare_fields(a, b, ["y", "x"])) == [(4, 0, 0, 1, 0.0)]
    assert rows(check.first_differences(a, b, ["y", "x"])) == [(0, 3, 2.0, None)]


def test_monthly_bounds_need_mid_months(spark):
    t = spark.sql("SELECT timestamp_ntz'2001-02-15 00:00:00' AS point")
    assert timeaxis.guess_month_bounds(t).selectExpr("date_format(lo, 'yyyy-MM-dd')", "date_format(hi, 'yyyy-MM-dd')").first() == ("2001-02-01", "2001-03-01")
    with pytest.raises(ValueError):
        timeaxis.guess_month_bounds(t.selectExpr("point + interval 1 day AS point"))


def test_radiation_years(spark):
    g = spark.createDataFrame([("CO2", 0, 365.0 * (165 + i) + 180, 400.0 + i) for i in range(4)], "gas STRING, sector INT, days DOUBLE, value DOUBLE")
    got = {r["year"]: r["value"] / (1.5188e-6) for r in gases.radiation_series(g, "scenario", 2000, 2019).collect()}
    assert got == pytest.approx({2015: 400.0, 2016: 400.5, 2017: 401.5, 2018: 402.5, 2019: 403.5})
    assert gases.radiation_series(g, "scenario", 2016).count() == 1
    with pytest.raises(ValueError):
        gases.radiation_series(g, "scenario", 2019, 2016)


def test_species_must_all_be_there(spark):
    d = [(0, s, 1.0) for s in range(4)] + [(1, s, 1.0) for s in range(3)] + [(2, s, None if s == 3 else 1.0) for s in range(4)]
    f = spark.createDataFrame(d, "cell INT, species INT, value DOUBLE")
    assert rows(gases.add_species(f, ["cell"])) == [(0, 4.0), (2, None)]


def test_merge_meets_across_a_rounding_step(spark):
    """Coordinates 2e-14 apart to either side of a step are one place; so are chains of gaps within the tolerance, and only those."""
    one = spark.createDataFrame([(1.00000000004999, 5.0, 1.0), (3.0, 5.0, 2.0), (4.0, 5.0, NAN)], "lat DOUBLE, lon DOUBLE, value DOUBLE")
    two = spark.createDataFrame([(1.00000000005001, 5.00000000005, 7.0), (3.0000000003, 5.0, 8.0), (4.0, 5.00000000009, 9.0)], "lat DOUBLE, lon DOUBLE, value DOUBLE")
    got = rows(merge.merge(one, two), "lat", "lon", "value")
    assert [(round(a, 6), v) for a, _, v in got] == [(1.0, 1.0), (3.0, 2.0), (3.0, 8.0), (4.0, 9.0)] and {o for _, o, _ in got} == {5.0}
    chain = spark.createDataFrame([(2.0 + k * 9e-11, -0.0, float(k)) for k in range(40)], "lat DOUBLE, lon DOUBLE, value DOUBLE")
    places = merge.common_places([chain], ("lat", "lon")).collect()
    assert {r["at"] for r in places if r["axis"] == 0} == {2.0} and len([r for r in places if r["axis"] == 0]) > 30
    far = spark.createDataFrame([(9e8, 1.0, 1.0), (9e8 + 1e-6, 1.0, 2.0), (None, 1.0, 3.0)], "lat DOUBLE, lon DOUBLE, value DOUBLE")
    assert rows(merge.merge(far, far.limit(0)), "lat", "value") == rows(far, "lat", "value")


def test_within_tolerance_matches_all_pairs(spark):
    rng = np.random.default_rng(2)
    a = [float(v) for v in rng.integers(0, 40, 300) * 4e-11 + rng.choice([0.0, 1.0, -3.0, 1e9], 300)] + [NAN, None, 0.0]
    b = [float(v) for v in rng.integers(0, 40, 25) * 4e-11 + rng.choice([0.0, 1.0, -3.0, 1e9], 25)] + [None]
    got = merge.within_tolerance(spark.createDataFrame([(v,) for v in a], "v DOUBLE"), "v", spark.createDataFrame([(v,) for v in b], "k DOUBLE"), "k")
    want = sorted(((v, v is not None and any(w is not None and abs(v - w) <= 1e-10 for w in b)) for v in a), key=repr)
    assert repr(sorted(((r["v"], r["hit"]) for r in got.collect()), key=repr)) == repr(want)
