"""User operations on tiles of a field, with a halo; the result must not depend on the tiling."""

from __future__ import annotations

import math
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Cells of a tile without its halo: what an operation gets does not grow with the grid.
TILE_CELLS = 250_000


def tile_shape(ny: int, nx: int, cells: int = TILE_CELLS) -> tuple[int, int]:
    """Rows and columns of a tile: as square as the grid allows, at most `cells` cells."""
    side = max(math.isqrt(cells), 1)
    rows = min(ny, max(side, cells // max(nx, 1)))
    return max(rows, 1), max(min(nx, cells // max(rows, 1)), 1)


def _places(index: str, size: int, n: int, halo: int, circular: bool) -> str:
    """SQL for the tiles along one axis that hold an index, as ``(t, s)``: tile number and by how much the index is shifted for it."""
    last = (n - 1) // size
    out = []
    for shift in (0, n, -n) if circular else (0,):
        at = f"({index} + {shift})"
        first, final = f"greatest(CAST(floor(({at} - {halo}) / {size}) AS INT), 0)", f"least(CAST(floor(({at} + {halo}) / {size}) AS INT), {last})"
        tiles = f"IF({first} <= {final}, sequence({first}, {final}), array())"
        # The last tile may be narrower than the others: what lies beyond its halo does not belong to it.
        near = f"filter({tiles}, t -> {at} >= t * {size} - {halo} AND {at} < least((t + 1) * {size}, {n}) + {halo})"
        out.append(f"transform({near}, t -> named_struct('t', t, 's', {shift}))")
    return f"concat({', '.join(out)})"


def apply_tiled(
    cells: DataFrame, operation: Callable[[pd.DataFrame], pd.DataFrame], schema: str, ny: int, nx: int,
    tile: tuple[int, int] | None = None, halo: int = 0, circular: bool = True, by: list[str] | None = None,
) -> DataFrame:
    """Run `operation` on each tile (rows and columns given by `tile`, else by a budget of cells) as a pandas frame.

    The frame holds the tile's rows (``_own`` true) and copies of the rows up to `halo` cells around it; those keep their
    place in the index space of the tile, so x may leave 0..nx-1.  The operation returns rows of its own cells only.
    """
    by = by or []
    sy, sx = tile or tile_shape(ny, nx)
    out = cells.withColumn("_py", F.expr(f"explode({_places('y', sy, ny, halo, False)})")).withColumn("_px", F.expr(f"explode({_places('x', sx, nx, halo, circular)})"))
    own = F.expr(f"_py.t = y DIV {sy} AND _px.t = x DIV {sx} AND _px.s = 0")
    out = out.withColumn("_own", own).withColumn("_ty", F.col("_py.t")).withColumn("_tx", F.col("_px.t")).withColumn("x", (F.col("x") + F.col("_px.s")).cast("int"))
    return out.drop("_py", "_px").groupBy(*by, "_ty", "_tx").applyInPandas(operation, schema)


def apply_tiled_pair(
    source: DataFrame, target: DataFrame, operation: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str,
    ny: int, nx: int, tile: tuple[int, int] | None = None,
) -> DataFrame:
    """Run an operation on matching tiles of two fields on one grid."""
    sy, sx = tile or tile_shape(ny, nx)
    tiled = [df.withColumn("_ty", F.expr(f"CAST(y DIV {sy} AS INT)")).withColumn("_tx", F.expr(f"CAST(x DIV {sx} AS INT)")).groupBy("_ty", "_tx") for df in (source, target)]
    return tiled[0].cogroup(tiled[1]).applyInPandas(operation, schema)
