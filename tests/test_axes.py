import pytest

from gridloom.sources import axes as ax
from tests.conftest import rows


def test_regular_axis_and_facts_agree_with_the_table(spark):
    a = ax.regular_axis(spark, 4, 90.0, -45.0)
    known = ax.facts(a)[0]
    found = ax.facts(a.select("*"))[0]
    assert known == found == ax.Facts(4, -90.0, 90.0, -67.5, 67.5, 3, 45.0)


def test_global_grid_checks(spark):
    y, x = ax.regular_grid(spark, nx=4, ny=3, offset_poles=False)
    assert [r["point"] for r in y.orderBy("idx").collect()] == [-90.0, 0.0, 90.0]
    assert [r["lo"] for r in y.orderBy("idx").collect()] == [-90.0, -45.0, 45.0]
    assert [r["point"] for r in x.orderBy("idx").collect()] == [0.0, 90.0, 180.0, 270.0]
    with pytest.raises(ValueError):
        ax.regular_grid(spark, nx=4, dx=80.0, ny=3)
    with pytest.raises(ValueError):
        ax.regular_grid(spark, nx=4, ny=3, is_global=False)


@pytest.mark.parametrize("edges,lo,hi", [
    ([15.0, 30.0], [5.0, 15.0, 30.0], [15.0, 30.0, 50.0]),
    ([4.0, 15.0, 30.0], [4.0, 15.0, 30.0], [15.0, 30.0, 50.0]),
    ([15.0, 30.0, 47.0], [5.0, 15.0, 30.0], [15.0, 30.0, 47.0]),
    ([4.0, 15.0, 30.0, 47.0], [4.0, 15.0, 30.0], [15.0, 30.0, 47.0]),
])
def test_variable_axis_mirrors_missing_edges(spark, edges, lo, hi):
    p = spark.createDataFrame(list(enumerate([10.0, 20.0, 40.0])), "idx INT, point DOUBLE")
    e = spark.createDataFrame(list(enumerate(edges)), "idx INT, point DOUBLE")
    got = ax.variable_axis(p, e).orderBy("idx").collect()
    assert [r["lo"] for r in got] == lo and [r["hi"] for r in got] == hi


def test_hybrid_levels(spark):
    theta = spark.createDataFrame(list(enumerate([0.0, 0.2, 0.6, 1.0])), "idx INT, eta DOUBLE")
    rho = spark.createDataFrame([(1, 0.1), (2, 0.4), (3, 0.8)], "idx INT, eta DOUBLE")
    got = ax.hybrid_levels(theta, rho, 1000.0, 2).orderBy("level").collect()
    assert [(round(r["height"], 6), round(r["height_lo"], 6), round(r["height_hi"], 6)) for r in got] == [(200, 0, 400), (600, 400, 800), (1000, 800, 1200)]
    assert [round(r["sigma"], 6) for r in got] == [0.25, 0.0, 0.0]
    assert [round(r["sigma_lo"], 6) for r in got] == [1.0, 0.0, 0.0]


def test_runs_join_across_blocks(spark):
    idx = [0, 1, 2, 3, 4, 5, 6, 7, 8, 11, 12, 15, 16, 17, 30]
    df = spark.createDataFrame([(i,) for i in idx], "idx LONG")
    want = [(0, 8, 9), (11, 12, 2), (15, 17, 3), (30, 30, 1)]
    for block in (2, 3, 4, 5, 1 << 20):
        assert rows(ax.contiguous_runs(df, block=block), "first", "last", "size") == sorted(want, key=repr)


def test_union_refuses_to_interleave(spark):
    a = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 3.0)], "idx INT, point DOUBLE")
    b = spark.createDataFrame([(0, 3.0 + 1e-12), (1, 4.0)], "idx INT, point DOUBLE")
    assert [r["point"] for r in ax.union_axes(a, b).orderBy("idx").collect()] == [1.0, 2.0, 3.0, 4.0]
    with pytest.raises(ValueError):
        ax.union_axes(a, spark.createDataFrame([(0, 2.5)], "idx INT, point DOUBLE"))


def test_overlap_outside_raises(spark):
    a = ax.regular_axis(spark, 4, 0.0, 10.0)
    with pytest.raises(ValueError):
        ax.overlapping_indices(a, 100.0, 110.0)
    got = ax.overlapping_indices(a, 15.0, 16.0, pad=1)
    assert rows(got) == [(0,), (1,), (2,)]


def test_guess_bounds_stays_within_the_poles(spark):
    a = spark.createDataFrame([(0, -89.0), (1, 0.0), (2, 89.0)], "idx INT, point DOUBLE")
    got = ax.guess_bounds(a, latitude=True).orderBy("idx").collect()
    assert [r["lo"] for r in got] == [-90.0, -44.5, 44.5] and got[2]["hi"] == 90.0
