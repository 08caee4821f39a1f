"""Connected regions: labelling, flood fill, glacial ice, lakes.

Cells of a row that touch and agree are first folded into runs, so the graph that is searched holds one node per run and
only the links between rows.  Components are then found by repeated contraction: every node joins the node with the smallest
seeded hash within two links, and the shrunken graph goes on.  The graph shrinks by a constant factor per round, so the number of
rounds grows with the logarithm of its size, not with the length of a region.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.session import discard, lookup, materialise, merged, row_count, small
from gridloom.operators.classes import ICE, SOIL
from gridloom.operators.merge import inside_polygons
from gridloom.operators.stencil import neighbourhood
from gridloom.sources.axes import facts


#: Degrees from a lake's seed to the sides of the box it is looked for in, before the box is widened.
LAKE_BOX = 0.8


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(node, root)`` for nodes and undirected edges ``(a, b)``; the root is the smallest node of the component."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    e = materialise(both.filter("a <> b").distinct())
    picks: list[DataFrame] = []
    while row_count(e):
        seed = F.lit(len(picks))

        def ranked(c: str) -> Column:
            return F.struct(F.xxhash64(F.col(c), seed).alias("h"), F.col(c).alias("n"))

        near = e.groupBy("a").agg(F.min(ranked("b")).alias("best")).select("a", F.least(ranked("a"), F.col("best")).alias("best"))
        # A second hop: the best of what the neighbours found.  Twice the shrinking for one lineage cut.
        heard = lookup(e, near.select(F.col("a").alias("b"), F.col("best").alias("_heard")), ["b"], at_most=row_count(e))
        far = heard.groupBy("a").agg(F.min("_heard").alias("_heard"))
        pick = near.join(merged(far), "a").select(F.col("a").alias("node"), F.least("best", "_heard")["n"].alias("to"))
        pick = materialise(pick)
        picks.append(pick)
        moved = lookup(e.withColumnRenamed("a", "node"), pick, ["node"]).select(F.col("to").alias("a"), "b")
        moved = lookup(moved.withColumnRenamed("b", "node"), pick, ["node"]).select("a", F.col("to").alias("b"))
        shrunk = materialise(moved.filter("a <> b").distinct())
        discard(e)
        e = shrunk
    discard(e)
    if not picks:
        return nodes.select("node", F.col("node").alias("root"))
    final, most = picks[-1], row_count(picks[0])
    for pick in reversed(picks[:-1]):
        later = final.select(F.col("node").alias("to"), F.col("to").alias("_end"))
        # The nodes of a round are targets of the round before, so `later` is no longer than `pick`.
        final = lookup(pick, later, ["to"], "left", at_most=row_count(pick)).select("node", F.coalesce("_end", "to").alias("to"))
    final = materialise(nodes.select("node").join(small(final, most), "node", "left").select("node", F.coalesce("to", "node").alias("to")))
    discard(*picks)
    roots = materialise(final.groupBy("to").agg(F.min("node").alias("root")))
    return lookup(final, roots, ["to"]).select("node", "root")


def label_regions(
    cells: DataFrame, nx: int, value: str = "code", extended: bool = False, wrap: bool = True, by: list[str] | None = None,
) -> DataFrame:
    """Add `region`: the smallest cell number ``y * nx + x`` of the connected cells with the same value (`by` apart).

    `extended` also connects corners.  Masked cells belong to no region and are dropped.  With `by`, region numbers are
    unique within a group only.
    """
    by = by or []
    c = cells.filter(F.col(value).isNotNull())
    row = Window.partitionBy(*by, "y").orderBy("x")
    new = ~(F.coalesce(F.lag("x").over(row) == F.col("x") - 1, F.lit(False)) & F.coalesce(F.lag(value).over(row) == F.col(value), F.lit(False)))
    start = F.last(F.when(new, F.col("x")), ignorenulls=True).over(row.rowsBetween(Window.unboundedPreceding, 0))
    number = (F.col("y").cast("long") * nx + start)
    # A cell of group k gets its own node space, without assuming anything about the group's type.
    node = F.struct(*by, number.alias("cell")) if by else number
    c = materialise(c.withColumn("_new", new).withColumn("_node", node))
    reach = F.array(F.lit(-1), F.lit(0), F.lit(1)) if extended else F.array(F.lit(0))
    up = c.select(*by, (F.col("y") + 1).alias("y"), F.explode(reach).alias("_d"), "x", value, F.col("_node").alias("a"))
    x = F.col("x") + F.col("_d")
    up = up.withColumn("x", F.pmod(x, F.lit(nx)).cast("int") if wrap else x).drop("_d")
    below = small(c.select(*by, "y", "x", value, F.col("_node").alias("b")), row_count(c))
    links = up.join(below, by + ["y", "x", value]).select("a", "b").distinct()
    if wrap:
        first = c.filter("x = 0").select(*by, "y", value, F.col("_node").alias("a"))
        last = c.filter(F.col("x") == nx - 1).select(*by, "y", value, F.col("_node").alias("b"))
        links = links.unionByName(first.join(last, by + ["y", value]).select("a", "b"))
    roots = components(c.filter("_new").select(F.col("_node").alias("node")), links)
    out = lookup(c, roots.withColumnRenamed("node", "_node"), ["_node"], at_most=row_count(c))
    return out.withColumn("region", F.col("root.cell") if by else F.col("root")).drop("_node", "_new", "root")


def find_similar(cells: DataFrame, seed: tuple[int, int], nx: int, value: str = "code", extended: bool = False, wrap: bool = False) -> DataFrame:
    """Cells of the region that the seed cell (y, x) lies in."""
    at_seed = cells.filter((F.col("y") == seed[0]) & (F.col("x") == seed[1])).select(F.col(value).alias("_seed")).limit(1)
    # Only cells with the seed's value can be in its region.
    alike = cells.join(F.broadcast(at_seed), F.col(value) == F.col("_seed"), "left_semi")
    lab = label_regions(alike, nx, value, extended, wrap)
    at = lab.filter((F.col("y") == seed[0]) & (F.col("x") == seed[1])).select("region")
    return lab.join(F.broadcast(at.limit(1)), "region", "left_semi").select("y", "x")


def floodfill(
    cells: DataFrame, seed: tuple[int, int], fill: int, nx: int, value: str = "code", extended: bool = False, wrap: bool = False,
) -> DataFrame:
    """Set the seed's region to `fill`; a seed that already has that value raises."""
    row = cells.filter((F.col("y") == seed[0]) & (F.col("x") == seed[1])).select(value).first()
    if row is None:
        raise ValueError(f"seed {seed} is not in the field")
    if row[0] == fill:
        raise ValueError(f"the field already has the value {fill} at seed {seed}")
    region = find_similar(cells, seed, nx, value, extended, wrap).withColumn("_hit", F.lit(True))
    out = cells.join(region, ["y", "x"], "left")
    return out.withColumn(value, F.when(F.col("_hit"), F.lit(fill)).otherwise(F.col(value))).drop("_hit")


def keep_glacial_ice(fractions: DataFrame, nx: int, wrap: bool = True, half: int = 2) -> DataFrame:
    """Ice regions without a cell wholly surrounded by ice (5x5) become soil.

    Fractions are long-form with class levels; ice must already be all or nothing, on a dense grid.
    """
    ice = fractions.filter(F.col("pl") == ICE).select("y", "x", F.col("value").alias("ice"))
    seeds = neighbourhood(ice, nx, wrap, "ice", equal_to=1.0, half=(half, half), centre=True)
    seeds = seeds.select("y", "x", "ice", F.col("all_equal").alias("core"))
    lab = label_regions(seeds.filter("ice = 1"), nx, "ice", extended=True, wrap=wrap)
    kept = materialise(lab.filter("core").select("region").distinct())
    glacial = lookup(lab, kept, ["region"]).select("y", "x", F.lit(True).alias("_glacial"))
    # Any ice outside the kept regions goes, also ice that is not a whole fraction.
    lost = ice.filter("ice > 0 AND NOT isnan(ice)").join(glacial, ["y", "x"], "left_anti").select("y", "x", F.lit(True).alias("_lost"))
    out = fractions.join(lost, ["y", "x"], "left")
    v = F.when(F.col("_lost") & (F.col("pl") == ICE), 0.0).when(F.col("_lost") & (F.col("pl") == SOIL), 1.0)
    return out.withColumn("value", F.coalesce(v, F.col("value"))).drop("_lost")


def fill_lakes(
    cells: DataFrame, lakes: DataFrame, axis_y: DataFrame, axis_x: DataFrame, nx: int, source_codes: list[int], target: int,
    outlines: DataFrame | None = None, code: str = "code",
) -> DataFrame:
    """Recode all lakes in one job: each lake's region of equal code around its seed becomes `target`.

    `lakes` ``(lake, lat, lon, lat_min, lat_max, lon_min, lon_max)`` gives a seed and the box the fill may not leave;
    without a box, `LAKE_BOX` degrees around the seed and a quarter of that box's diagonal beyond.  `outlines` ``(poly, x1, y1, x2, y2)`` with poly = lake further confine the
    fill to cells whose centre is inside.  Lakes whose seed has neither a source code are left alone, as are boxes of a
    single row or column.
    """
    reach = F.lit(LAKE_BOX + LAKE_BOX * 8.0**0.5 / 4)
    box = lakes.select(
        "lake", "lat", "lon",
        F.coalesce("lat_min", F.col("lat") - reach).alias("_s"), F.coalesce("lat_max", F.col("lat") + reach).alias("_n"),
        F.coalesce("lon_min", F.col("lon") - reach).alias("_w"), F.coalesce("lon_max", F.col("lon") + reach).alias("_e"),
    )

    def spans(axis, low, high, seed, name):
        # Rows or columns of each lake's box, found by binning the axis, and the one nearest the seed.
        f = facts(axis)[0]
        width = (f.hi - f.lo) / f.n
        b = box.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))))
        a = axis.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor(F.col("hi") / width))))
        # Both sides are cut into bins; a pair counts in the first bin both share.
        first = F.greatest(F.floor(F.col("lo") / width), F.floor(F.col(low) / width))
        hit = b.join(a, "_bin").filter(F.col("_bin") == first).filter((F.col("hi") > F.col(low)) & (F.col("lo") < F.col(high)))
        hit = hit.withColumn("_d", F.round(F.abs(F.col("point") - F.col(seed)), 9))
        span = hit.groupBy("lake").agg(
            F.min("idx").alias("_lo"), F.max("idx").alias("_hi"), F.min_by("idx", F.struct("_d", "idx")).alias("_seed_" + name)
        )
        return span.filter("_hi > _lo").select("lake", F.sequence("_lo", "_hi").alias("_" + name), "_seed_" + name)

    boxes = spans(axis_y, "_s", "_n", "lat", "y").join(merged(spans(axis_x, "_w", "_e", "lon", "x")), "lake")
    # Only boxes around a seed of a source code are opened, and only cells of that code can be reached in them.
    sources = cells.select("y", "x", code).filter(F.col(code).isin(source_codes))
    at_seed = sources.select(F.col("y").alias("_seed_y"), F.col("x").alias("_seed_x"), code)
    # By merging: there is a box per lake, too many to be held by every task.
    seeded = materialise(merged(boxes).join(at_seed, ["_seed_y", "_seed_x"]))
    places = seeded.withColumn("y", F.explode("_y")).withColumn("x", F.explode("_x"))
    seed = (F.col("y") == F.col("_seed_y")) & (F.col("x") == F.col("_seed_x"))
    places = places.select("lake", "y", "x", code, seed.alias("_seed"))
    # The boxes are opened here, so their table says little of how many places there are.
    part = materialise(merged(places).join(sources, ["y", "x", code]))
    if outlines is not None:
        centres = inside_polygons(
            part.select("y", "x").distinct(), outlines, axis_y, axis_x, corners=False
        ).filter("inside").select("y", "x")
        part = part.join(merged(centres), ["y", "x"], "left_semi")
    lab = materialise(label_regions(part, nx, code, wrap=False, by=["lake"]))
    wanted = lab.filter("_seed").select("lake", "region")
    hit = lab.join(small(wanted), ["lake", "region"], "left_semi").select("y", "x").distinct().withColumn("_lake", F.lit(True))
    out = cells.join(merged(hit), ["y", "x"], "left")
    return out.withColumn(code, F.when(F.col("_lake"), F.lit(target)).otherwise(F.col(code))).drop("_lake")
