import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom import session
from gridloom.operators import fill
from gridloom.operators import regions as rg
from gridloom.functions.columns import search_distance
from gridloom.operators import rivers as rv
from gridloom.sources import axes as ax
from tests.conftest import as_grid, grid_frame, rows


def flood(data, extended, wrap):
    """Region labels by a plain search."""
    ny, nx = len(data), len(data[0])
    steps = [(0, 1), (0, -1), (1, 0), (-1, 0)] + ([(1, 1), (1, -1), (-1, 1), (-1, -1)] if extended else [])
    label = {}
    for start in range(ny * nx):
        if start in label or data[start // nx][start % nx] is None:
            continue
        todo = [start]
        label[start] = start
        while todo:
            c = todo.pop()
            y, x = divmod(c, nx)
            for dy, dx in steps:
                b, a = y + dy, x + dx
                if wrap:
                    a %= nx
                if 0 <= b < ny and 0 <= a < nx and data[b][a] == data[y][x] and b * nx + a not in label:
                    label[b * nx + a] = start
                    todo.append(b * nx + a)
    return label


@pytest.mark.parametrize("extended,wrap", [(False, False), (True, True), (False, True)])
def test_labels_match_a_plain_search(spark, extended, wrap):
    rng = np.random.default_rng(11)
    data = [[None if rng.random() < 0.1 else int(rng.integers(0, 2)) for _ in range(17)] for _ in range(13)]
    got = rg.label_regions(grid_frame(spark, data, "code", "INT"), 17, extended=extended, wrap=wrap)
    assert {r["y"] * 17 + r["x"]: r["region"] for r in got.collect()} == flood(data, extended, wrap)


def test_groups_are_labelled_apart(spark):
    a = grid_frame(spark, [[1, 1, 2]], "code", "INT").withColumn("g", F.lit("a"))
    b = grid_frame(spark, [[1, 1, 1]], "code", "INT").withColumn("g", F.lit("b"))
    got = rg.label_regions(a.unionByName(b), 3, wrap=False, by=["g"])
    assert rows(got, "g", "x", "region") == [("a", 0, 0), ("a", 1, 0), ("a", 2, 2), ("b", 0, 0), ("b", 1, 0), ("b", 2, 0)]


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    hub = spark.range(1001, 1400).select(F.lit(1000).cast("long").alias("a"), F.col("id").alias("b"))
    nodes = spark.range(301).unionByName(spark.range(1000, 1401)).withColumnRenamed("id", "node")
    got = rg.components(nodes, chain.unionByName(hub))
    assert rows(got.groupBy("root").agg(F.count(F.lit(1)).alias("n"))) == [(0, 301), (1000, 400), (1400, 1)]


def test_floodfill_checks_its_seed(spark):
    f = grid_frame(spark, [[1, 1, 0], [0, 0, 1]], "code", "INT")
    assert as_grid(rg.floodfill(f, (0, 0), 7, 3), "code") == [[7, 7, 0], [0, 0, 1]]
    assert as_grid(rg.floodfill(f, (0, 0), 7, 3, extended=True), "code") == [[7, 7, 0], [0, 0, 7]]
    assert as_grid(rg.floodfill(f, (0, 0), 7, 3, extended=True, wrap=True), "code") == [[7, 7, 0], [0, 0, 7]]
    with pytest.raises(ValueError):
        rg.floodfill(f, (0, 2), 0, 3)
    with pytest.raises(ValueError):
        rg.floodfill(f, (9, 9), 0, 3)


def test_only_ice_with_a_core_stays(spark):
    ice = np.zeros((9, 14))
    ice[0:6, 0:6] = 1
    ice[6, 6] = 1  # joined to the sheet by a corner
    ice[7, 10:13] = 1
    ice[3, 9] = 0.4  # partial ice is no region
    data = [(9, y, x, float(ice[y, x])) for y in range(9) for x in range(14)] + [(8, y, x, 0.0) for y in range(9) for x in range(14)]
    f = spark.createDataFrame(data, "pl INT, y INT, x INT, value DOUBLE")
    got = rg.keep_glacial_ice(f, 14, wrap=False)
    left = np.array(as_grid(got.filter("pl = 9")))
    soil = np.array(as_grid(got.filter("pl = 8")))
    want = ice.copy()
    want[7, 10:13] = want[3, 9] = 0
    assert (left == want).all() and (soil == ((ice > 0) & (want == 0))).all()


def test_lakes(spark):
    data = [[5] * 12 for _ in range(10)]
    for y in range(2, 5):
        for x in range(2, 6):
            data[y][x] = 1
    data[8][8] = data[8][9] = 1
    f = grid_frame(spark, data, "code", "INT")
    y, x = ax.regular_axis(spark, 10, 0.0, 1.0), ax.regular_axis(spark, 12, 0.0, 1.0)
    schema = "lake STRING, lat DOUBLE, lon DOUBLE, lat_min DOUBLE, lat_max DOUBLE, lon_min DOUBLE, lon_max DOUBLE"
    lakes = spark.createDataFrame(
        [("big", 3.5, 3.5, 2.0, 5.0, 2.0, 5.0), ("small", 8.4, 8.4, None, None, None, None), ("dry", 6.5, 6.5, 5.0, 8.0, 5.0, 8.0)], schema
    )
    got = as_grid(rg.fill_lakes(f, lakes, y, x, 12, [1], 9), "code")
    assert all(got[j][i] == 9 for j in (2, 3, 4) for i in (2, 3, 4)) and got[3][5] == 1  # column 5 is outside the box
    assert got[8][8] == 9 and got[8][9] == 9 and got[6][6] == 5
    edges = spark.createDataFrame([("big", 1.9, 1.9, 3.1, 1.9), ("big", 3.1, 1.9, 3.1, 6.0), ("big", 3.1, 6.0, 1.9, 6.0), ("big", 1.9, 6.0, 1.9, 1.9)], "poly STRING, x1 DOUBLE, y1 DOUBLE, x2 DOUBLE, y2 DOUBLE")
    kept = as_grid(rg.fill_lakes(f, lakes.filter("lake = 'big'").withColumn("lon", F.lit(2.5)), y, x, 12, [1], 9, edges), "code")
    assert kept[3][2] == 9 and kept[3][3] == 1


def sequential_regions(r, small=1e-5):
    """Largest remaining cell claims what it reaches, again and again."""
    r = r.copy()
    ny, nx = r.shape
    r[0, :] = r[-1, :] = r[:, 0] = r[:, -1] = 0
    owner, number = {}, 0
    while r.max() >= small:
        y, x = np.unravel_index(r.argmax(), r.shape)
        number += 1
        todo = [(y, x, r[y, x])]
        owner[y * nx + x] = (number, r[y, x])
        r[y, x] = 0
        while todo:
            y, x, amount = todo.pop()
            for dy in (-1, 0, 1):
                for dx in (-1, 0, 1):
                    b, a = min(max(y + dy, 0), ny - 1), (x + dx) % nx
                    if small < r[b, a] <= 1.1 * amount:
                        owner[b * nx + a] = (number, r[b, a])
                        todo.append((b, a, r[b, a]))
                        r[b, a] = 0
    return owner


@pytest.mark.parametrize("seed,share", [(1, 0.25), (2, 0.8)])
def test_river_regions_match_the_sequential_search(spark, seed, share):
    rng = np.random.default_rng(seed)
    r = np.where(rng.random((12, 15)) < share, rng.random((12, 15)), 0.0)
    cells = grid_frame(spark, r.tolist(), "r")
    found = rv.number_rivers(rv.runoff_regions(rv.valid_runoff(cells, 12, 15), 12, 15, hops=2))
    owner = sequential_regions(r)
    total = {}
    for n, v in owner.values():
        total[n] = total.get(n, 0.0) + v
    rank = {n: i + 1 for i, n in enumerate(sorted(total, key=lambda n: (-round(total[n], 9), n)))}
    assert {q["cell"]: q["river"] for q in found.collect()} == {c: rank[n] for c, (n, _) in owner.items()}
    with pytest.raises(ValueError):
        rv.number_rivers(rv.runoff_regions(rv.valid_runoff(cells, 12, 15), 12, 15), max_rivers=1)


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    """10,099 cells, each smaller than the one before, wound up in rows with dry rows between: one region, a logarithm of cuts."""
    ny, nx, chain = 203, 104, []
    for k in range(100):
        line = [(1 + 2 * k, x) for x in range(1, 101)]
        chain += line[::-1] if k % 2 else line
        chain.append((2 + 2 * k, chain[-1][1]))
    # Each cell is more than a tenth above the next, so none reaches its predecessor.
    rows_ = [(y, x, 1e300 * 1.11 ** -i) for i, (y, x) in enumerate(chain[:-1])]
    cuts = []
    plain = rv.materialise
    monkeypatch.setattr(rv, "materialise", lambda df: cuts.append(1) or plain(df))
    cells = spark.createDataFrame(rows_, "y INT, x INT, r DOUBLE")
    got = rv.runoff_regions(cells, ny, nx).groupBy("root").count().collect()
    assert [(r["root"], r["count"]) for r in got] == [(1 * nx + 1, len(rows_))]
    assert len(rows_) == 10_099 and len(cuts) < 30, len(cuts)


def test_gaps_are_closed_like_one_by_one(spark):
    rng = np.random.default_rng(4)
    for _ in range(3):
        ocean = rng.choice([0, 2, 3, 5, 6, 9, 10, 11], 40)
        land = rng.choice([0, 3, 4, 6, 10, -2], 20)
        o, l = ocean.copy(), land.copy()
        removed = 0
        for loop in range(1, int(ocean.max()) + 1):
            river = loop - removed
            if not (l == river).any() and (o == river).any():
                o[o == river] = 0
                o[o > river] -= 1
                l[l > river] -= 1
                removed += 1
        of = spark.createDataFrame([(i, int(v)) for i, v in enumerate(ocean)], "cell INT, river INT")
        lf = spark.createDataFrame([(i, int(v)) for i, v in enumerate(land)], "id INT, river INT")
        a, b = rv.close_gaps(of, lf)
        assert [r["river"] for r in a.orderBy("cell").collect()] == o.tolist()
        assert [r["river"] for r in b.orderBy("id").collect()] == l.tolist()


def sequential_mouths(starts, sea, numbered, ny, nx):
    """One mouth after the other: (id, sy, sx, min_distance) in order -> numbers, changing `numbered`."""
    def around(y, x):
        return {(min(max(y + dy, 0), ny - 1), (x + dx) % nx) for dy in (-1, 0, 1) for dx in (-1, 0, 1) if dy or dx}

    def coast(y, x):
        return not sea[y][x] and any(sea[b][a] for b, a in around(y, x))

    def ring(sy, sx, y, x):
        if (y, x) == (sy, sx):
            return 1 if sy in (0, ny - 1) else nx
        return abs(y - sy) + min(abs(x - sx), nx - abs(x - sx))

    out = {}
    for i, sy, sx, reach in starts:
        cells = [(ring(sy, sx, y, x), y, x) for y in range(ny) for x in range(nx)]
        of_interest = [d for d, y, x in cells if numbered.get((y, x), 0) > 0 or coast(y, x)]
        if not of_interest:
            out[i] = -2
            continue
        radius = max(reach, min(of_interest))
        near = [(y, x) for d, y, x in cells if d <= radius]
        rivers = [numbered[c] for c in near if numbered.get(c, 0) > 0]
        if rivers:
            out[i] = min(rivers)
            continue
        wet = set()
        for start in (c for c in near if coast(*c)):
            seen, front = {start}, {start}
            for _ in range(3):
                step = {c for f in front for c in around(*f)}
                wet |= {c for c in step if sea[c[0]][c[1]]}
                front = {c for c in step if not sea[c[0]][c[1]]} - seen
                seen |= front
        rivers = [numbered[c] for c in wet if numbered.get(c, 0) > 0]
        if rivers or not wet:
            out[i] = min(rivers, default=-2)
            continue
        out[i] = max(numbered.values(), default=0) + 1
        for c in wet:
            numbered[c] = out[i]
    return out


@pytest.mark.parametrize("seed,outflows,scaling,tile", [(1, 0, 0.15, 5), (2, 6, 0.15, 256), (3, 3, 0.4, 7), (5, 2, 0.02, 4)])
def test_mouths_are_linked_as_one_by_one(spark, monkeypatch, seed, outflows, scaling, tile):
    monkeypatch.setattr(rv, "SETTLE_TILE", tile)
    rng = np.random.default_rng(seed)
    ny, nx = 14, 22
    sea = [[float((y // 3 + x // 4 + seed) % 3 > 0) for x in range(nx)] for y in range(ny)]
    ocean = grid_frame(spark, sea, "sea").withColumn("nav_lat", F.col("y") * 1.0).withColumn("nav_lon", F.col("x") * 1.0)
    wet = [(y, x) for y in range(ny) for x in range(nx) if sea[y][x]]
    numbered = {wet[k]: n + 1 for n, k in enumerate(rng.choice(len(wet), outflows, replace=False))}
    mouths = [(i, float(rng.integers(0, ny)), float(rng.integers(0, nx)), int(rng.integers(0, 40))) for i in range(45)]
    table = spark.createDataFrame([(y, x, n) for (y, x), n in numbered.items()], "y INT, x INT, river INT")
    frame = spark.createDataFrame(mouths, "id LONG, lat DOUBLE, lon DOUBLE, sequence INT")
    reach = {r["id"]: r["d"] for r in frame.select("id", search_distance(F.col("sequence"), scaling).alias("d")).collect()}
    want = sequential_mouths([(i, int(a), int(o), reach[i]) for i, a, o, _ in mouths], sea, now := dict(numbered), ny, nx)
    got, fresh = rv.link_mouths(frame, ocean, ocean.select("y", "x", "sea"), table, scaling, ny, nx)
    assert {r["id"]: r["river"] for r in got.collect()} == want
    assert {(r["y"], r["x"]): r["river"] for r in fresh.collect()} == {c: n for c, n in now.items() if c not in numbered}


def test_a_start_far_from_everything_is_found(spark):
    ny, nx = 40, 4000
    outs = spark.createDataFrame([(20, 0, 9)], "y INT, x INT, river INT")
    none = outs.limit(0)
    starts = spark.createDataFrame([(1, 20, 1500, 3), (2, 20, 2000, 1), (3, 0, 3999, 5)], "id LONG, sy INT, sx INT, min_distance INT")
    assert rows(rv.diamond_search(starts, outs, none, ny, nx), "id", "river", "radius") == [(1, 9, 1500), (2, 9, 2000), (3, 9, 21)]
    assert rows(rv.diamond_search(starts, none, none, ny, nx), "id", "river", "radius") == [(1, None, None), (2, None, None), (3, None, None)]
    assert rv.diamond_search(starts.limit(0), outs, none, ny, nx).collect() == []


def diamond(starts, outs, shore, ny, nx):
    """Every start against every cell."""
    out = []
    for i, sy, sx, reach in starts:
        far = {}
        for y, x in {(y, x) for y, x, _ in outs} | set(shore):
            own = 1 if sy in (0, ny - 1) else nx
            far[y, x] = own if (y, x) == (sy, sx) else abs(y - sy) + min(abs(x - sx), nx - abs(x - sx))
        radius = max(min(far.values()), reach) if far else None
        out.append((i, min((r for y, x, r in outs if far[y, x] <= radius), default=None), radius))
    return sorted(out)


@pytest.mark.parametrize("seed,ny,nx,n_outs,n_shore", [(1, 17, 40, 30, 40), (2, 70, 66, 3, 500), (3, 9, 9, 20, 0), (4, 130, 5, 200, 9), (5, 64, 64, 1, 1), (6, 1, 30, 4, 2)])
def test_diamonds_match_all_pairs(spark, seed, ny, nx, n_outs, n_shore):
    rng = np.random.default_rng(seed)
    places = lambda n: [(int(rng.integers(0, ny)), int(rng.integers(0, nx))) for _ in range(n)]
    outs = [(y, x, int(rng.integers(1, 60))) for y, x in places(n_outs)]
    shore, own = places(n_shore), [(y, x) for y, x, _ in outs[:5]]
    starts = [(i, y, x, int(rng.choice([0, 1, 3, 8, 40]))) for i, (y, x) in enumerate(places(60) + own + [(0, 0), (ny - 1, nx - 1)])]
    got = rv.diamond_search(
        spark.createDataFrame(starts, "id LONG, sy INT, sx INT, min_distance INT"), spark.createDataFrame(outs + [(0, 0, 0)], "y INT, x INT, river INT"),
        spark.createDataFrame(shore, "y INT, x INT"), ny, nx)
    assert rows(got, "id", "river", "radius") == sorted(diamond(starts, outs, shore, ny, nx), key=repr)


def test_what_a_start_meets_is_bounded(spark):
    """A start 1,500 cells from the shore, before 10,000 cells of coast and of outflows; one amid them with a wide reach."""
    ny, nx = 4096, 4096
    strip = spark.range(10_000).select((F.col("id") % 2500).cast("int").alias("y"), (F.floor(F.col("id") / 2500) + 1600).cast("int").alias("x"))
    outs = strip.filter("x > 1601").withColumn("river", (F.col("y") * 4 + F.col("x") - 1600 + 1).cast("int"))
    starts = spark.createDataFrame([(1, 1200, 100, 3), (2, 1200, 1601, 400), (3, 4000, 3000, 1)], "id LONG, sy INT, sx INT, min_distance INT")
    levels = rv._pyramid(outs.unionByName(strip.filter("x <= 1601").withColumn("river", F.lit(None).cast("int"))), ny, nx)
    met = {r["id"]: r["n"] for r in rv._descend(starts, levels, ny, nx).groupBy("id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert all(n <= 64 for n in met.values()), met
    got = rows(rv.diamond_search(starts, outs, strip.filter("x <= 1601"), ny, nx), "id", "river", "radius")
    strip_cells = [(r["y"], r["x"]) for r in strip.collect()]
    want = diamond([tuple(r) for r in starts.collect()], [tuple(r) for r in outs.collect()], [c for c in strip_cells if c[1] <= 1601], ny, nx)
    assert got == want


def test_lakes_without_a_box_reach_beyond_it(spark):
    f = grid_frame(spark, [[1] * 40 for _ in range(40)], "code", "INT")
    axis = ax.regular_axis(spark, 40, 0.0, 0.1)
    lakes = spark.createDataFrame([("a", 2.05, 2.05, None, None, None, None)], "lake STRING, lat DOUBLE, lon DOUBLE, lat_min DOUBLE, lat_max DOUBLE, lon_min DOUBLE, lon_max DOUBLE")
    got = np.array(as_grid(rg.fill_lakes(f, lakes, axis, axis, 40, [1], 9), "code")) == 9
    assert got[20].sum() == got[:, 20].sum() == 29 and got.sum() == 29 * 29  # 1.366 degrees to each side


def test_mouths_without_an_outflow_share_new_numbers(spark):
    ny, nx = 12, 30
    sea = [[1.0 if x >= 3 and x < 27 else 0.0 for x in range(nx)] for _ in range(ny)]
    ocean = grid_frame(spark, sea, "sea").withColumn("nav_lat", F.col("y") * 1.0).withColumn("nav_lon", F.col("x") * 1.0)
    numbered = spark.createDataFrame([(2, 26, 5)], "y INT, x INT, river INT")
    mouths = spark.createDataFrame(
        [(0, 2.2, 27.1, 0), (1, 5.0, 1.9, 0), (2, 6.1, 2.0, 0), (3, 11.0, 2.2, 0)], "id LONG, lat DOUBLE, lon DOUBLE, sequence INT"
    )
    got, fresh = rv.link_mouths(mouths, ocean, ocean.select("y", "x", "sea"), numbered, 0.34, ny, nx)
    river = {r["id"]: r["river"] for r in got.collect()}
    assert river[0] == 5
    assert river[1] == river[2] == 6 and river[3] in (6, 7)
    cells = {(r["y"], r["x"]) for r in fresh.collect()}
    assert cells and all(x in (3, 26) for _, x in cells)


def test_a_coastal_walk_broadcasts_nothing_that_grows(spark, monkeypatch):
    rng = np.random.default_rng(3)
    ny, nx = 9, 12
    data = [[int(rng.random() < 0.4) for _ in range(nx)] for _ in range(ny)]
    starts = {i: (int(rng.integers(0, ny)), int(rng.integers(0, nx))) for i in range(12)}
    plans, cut = [], rv.materialise
    # Tables on disk are small enough to be broadcast without being asked for.
    sea, places = cut(grid_frame(spark, data, "sea", "INT")), cut(spark.createDataFrame([(i, *p) for i, p in starts.items()], "id INT, y INT, x INT"))
    monkeypatch.setattr(rv, "materialise", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df))
    found = rv.coastal_walk(places, sea, ny, nx, 3)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    want = set()
    for i, start in starts.items():
        seen, front = {start}, {start}
        for _ in range(3):
            near = {(min(max(y + a, 0), ny - 1), (x + b) % nx) for y, x in front for a in (-1, 0, 1) for b in (-1, 0, 1) if a or b}
            want |= {(i, y, x) for y, x in near if data[y][x]}
            front = {p for p in near if not data[p[0]][p[1]]} - seen
            seen |= front
    assert rows(found) == sorted(want, key=repr)
    assert not any("Broadcast" in p for p in plans)


@pytest.mark.parametrize("hops", [3, 4])
def test_groups_that_tell_each_other_a_label_hang_below_its_source(spark, hops):
    # The group of row 1 (smaller numbers) and the one of rows 2 and 3 reach each other by steep steps down; the cell of row 4 reaches both.
    flow = {(1, x): r for x, r in zip(range(1, 6), (40.0, 43.0, 47.0, 51.0, 56.0))}
    flow |= {(2, 1): 48.0, (2, 6): 50.0} | {(3, x): 50.0 for x in range(1, 7)} | {(4, 3): 100.0}
    cells = spark.createDataFrame([(y, x, r) for (y, x), r in flow.items()], "y INT, x INT, r DOUBLE")
    got = rv.runoff_regions(cells, 8, 10, hops=hops)
    assert {r["root"] for r in got.collect()} == {43}


def test_mouths_strewn_over_tiles_take_few_rounds(spark, monkeypatch):
    monkeypatch.setattr(rv, "SETTLE_TILE", 4)
    rng = np.random.default_rng(7)
    ny, nx = 12, 60
    sea = [[float((y // 3 + x // 4) % 3 > 0) for x in range(nx)] for y in range(ny)]
    ocean = grid_frame(spark, sea, "sea").withColumn("nav_lat", F.col("y") * 1.0).withColumn("nav_lon", F.col("x") * 1.0)
    mouths = [(i, float(rng.integers(0, ny)), float(rng.integers(0, nx)), int(rng.integers(0, 10))) for i in range(300)]
    frame = spark.createDataFrame(mouths, "id LONG, lat DOUBLE, lon DOUBLE, sequence INT")
    cuts, cut = [], rv.materialise
    monkeypatch.setattr(rv, "materialise", lambda df: cuts.append(1) or cut(df))
    got, _ = rv.link_mouths(frame, ocean, ocean.select("y", "x", "sea"), spark.createDataFrame([], "y INT, x INT, river INT"), 0.15, ny, nx)
    # 273 with the mouths that make no number among those that hold up others.
    assert len(cuts) < 80
    reach = {r["id"]: r["d"] for r in frame.select("id", search_distance(F.col("sequence"), 0.15).alias("d")).collect()}
    assert {r["id"]: r["river"] for r in got.collect()} == sequential_mouths([(i, int(a), int(o), reach[i]) for i, a, o, _ in mouths], sea, {}, ny, nx)


def test_only_cells_between_tiles_exchange_labels(spark, monkeypatch):
    monkeypatch.setattr(rv, "CLAIM_TILE", 8)
    rng = np.random.default_rng(4)
    ny, nx = 30, 41
    flow = {(y, x): float(np.round(np.exp(3 * rng.random()), 2)) for y in range(ny) for x in range(nx) if rng.random() < 0.7}
    seen, search = [], rv.components
    monkeypatch.setattr(rv, "components", lambda nodes, edges: seen.append(nodes.count()) or search(nodes, edges))
    got = rv.runoff_regions(spark.createDataFrame([(y, x, r) for (y, x), r in flow.items()], "y INT, x INT, r DOUBLE"), ny, nx)
    want = {}
    for start in sorted(flow, key=lambda c: (-flow[c], c)):
        todo = [start] if start not in want else []
        want.setdefault(start, start)
        while todo:
            y, x = todo.pop()
            for c in {(min(max(y + a, 0), ny - 1), (x + b) % nx) for a in (-1, 0, 1) for b in (-1, 0, 1)}:
                if c in flow and c not in want and flow[c] <= 1.1 * flow[(y, x)]:
                    want[c] = want[start]
                    todo.append(c)
    assert {(r["y"], r["x"]): r["root"] for r in got.collect()} == {c: y * nx + x for c, (y, x) in want.items()}
    assert seen[0] < 0.8 * len(flow)


def test_starts_descend_without_a_window(spark, monkeypatch):
    outs = spark.createDataFrame([(y, x, 1 + (y * 7 + x) % 13) for y in range(0, 40, 3) for x in range(0, 50, 7)], "y INT, x INT, river INT")
    starts = spark.createDataFrame([(i, i * 5 % 40, i * 7 % 50, 1 + i % 6) for i in range(60)], "id LONG, sy INT, sx INT, min_distance INT")
    plans, cut = [], rv.materialise
    monkeypatch.setattr(rv, "materialise", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df))
    got = rv.diamond_search(starts, outs, outs.select("y", "x").limit(0), 40, 50)
    plans.append(got._jdf.queryExecution().executedPlan().toString())
    want = diamond([tuple(r) for r in starts.collect()], [tuple(r) for r in outs.collect()], [], 40, 50)
    assert rows(got, "id", "river", "radius") == sorted(want, key=repr)
    assert not any("Window" in p for p in plans)


def test_only_cells_a_lake_can_reach_are_searched(spark, monkeypatch):
    """Boxes around a seed of no source code are never opened, and of the others only cells of the seed's code go on."""
    data = [[5, 1, 2, 5] * 3 for _ in range(12)]
    f = grid_frame(spark, data, "code", "INT")
    y, x = ax.regular_axis(spark, 12, 0.0, 1.0), ax.regular_axis(spark, 12, 0.0, 1.0)
    lakes = spark.createDataFrame(
        [("dry", 4.5, 4.5, 0.0, 12.0, 0.0, 12.0), ("wet", 4.5, 5.5, 2.0, 8.0, 4.0, 8.0)],
        "lake STRING, lat DOUBLE, lon DOUBLE, lat_min DOUBLE, lat_max DOUBLE, lon_min DOUBLE, lon_max DOUBLE",
    )
    seen, plain = [], rg.materialise

    def kept(df):
        out = plain(df)
        if {"lake", "y", "x", "code"} <= set(df.columns):
            seen.append([(r["lake"], r["code"]) for r in out.collect()])
        return out

    monkeypatch.setattr(rg, "materialise", kept)
    got = as_grid(rg.fill_lakes(f, lakes, y, x, 12, [1, 2], 9), "code")
    assert [(j, i) for j in range(12) for i in range(12) if got[j][i] == 9] == [(j, 5) for j in range(2, 8)]
    assert seen and all(cells == [("wet", 1)] * 6 for cells in seen)


def joins(monkeypatch, *modules):
    """The joins of the tables that the modules write from now on, as they are optimised."""
    found = []
    for module in modules:
        def spied(df, cut=module.materialise):
            found.extend(x.strip() for x in df._jdf.queryExecution().optimizedPlan().toString().split("\n") if re.search(r"\bJoin \w", x))
            return cut(df)

        monkeypatch.setattr(module, "materialise", spied)
    return found


def test_opened_boxes_of_lakes_are_not_broadcast(spark, monkeypatch):
    """Their table is small on disk, but each row becomes a row per cell of the box."""
    found = joins(monkeypatch, rg)
    f = grid_frame(spark, [[1] * 12 for _ in range(10)], "code", "INT")
    y, x = ax.regular_axis(spark, 10, 0.0, 1.0), ax.regular_axis(spark, 12, 0.0, 1.0)
    lakes = spark.createDataFrame([(k, 3.5 + k % 5, 3.5, None, None, None, None) for k in range(9)], "lake INT, lat DOUBLE, lon DOUBLE, lat_min DOUBLE, lat_max DOUBLE, lon_min DOUBLE, lon_max DOUBLE")
    out = rg.fill_lakes(f, lakes, y, x, 12, [1], 9)
    cells = [j for j in found if re.search(r"\(y#\d+ = y#\d+\).*\(x#\d+ = x#\d+\).*\(code#\d+ = code#\d+\)", j)]
    assert cells and all("strategy=merge" in j for j in cells[:1])
    assert "strategy=merge" in next(j for j in out._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join LeftOuter" in j)
    assert out.filter("code = 9").count() == 7 * 3  # 1.366 degrees around seeds at 3.5 to 7.5 north and 3.5 east


def test_every_join_of_linked_mouths_is_sized(spark, monkeypatch):
    """No join is left to what Spark makes of a table's size on disk, and merged sides link as broadcast ones do."""
    monkeypatch.setattr(session, "BROADCAST_ROWS", 0)
    found = joins(monkeypatch, rv, fill)
    ny, nx = 12, 30
    sea = [[float((y // 3 + x // 4) % 3 > 0) for x in range(nx)] for y in range(ny)]
    ocean = grid_frame(spark, sea, "sea").withColumn("nav_lat", F.col("y") * 1.0).withColumn("nav_lon", F.col("x") * 1.0)
    rng = np.random.default_rng(4)
    mouths = [(i, float(rng.integers(0, ny)), float(rng.integers(0, nx)), int(rng.integers(0, 10))) for i in range(25)]
    frame = spark.createDataFrame(mouths, "id LONG, lat DOUBLE, lon DOUBLE, sequence INT")
    reach = {r["id"]: r["d"] for r in frame.select("id", search_distance(F.col("sequence"), 0.15).alias("d")).collect()}
    want = sequential_mouths([(i, int(a), int(o), reach[i]) for i, a, o, _ in mouths], sea, {}, ny, nx)
    got, _ = rv.link_mouths(frame, ocean, ocean.select("y", "x", "sea"), spark.createDataFrame([], "y INT, x INT, river INT"), 0.15, ny, nx)
    assert {r["id"]: r["river"] for r in got.collect()} == want
    assert len(found) > 20 and [j for j in found if "Hint" not in j] == []
