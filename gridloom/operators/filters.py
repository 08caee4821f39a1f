"""Sixth-order implicit low-pass filter: rows, then columns, each line solved whole inside one grouped task."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.columns import EARTH_RADIUS

# Fixed value: largest filter strength, a fiftieth of what single precision resolves.
MAX_STRENGTH = 1.0 / (50.0 * float(np.finfo("float32").eps))
#: Cells a grouped task solves at a time.
GROUP_CELLS = 200_000
#: Binomial stencils of the 2nd, 4th and 6th difference.
STENCILS = {1: (1, 2, 1), 2: (1, 4, 6, 4, 1), 3: (1, 6, 15, 20, 15, 6, 1)}


def strength_from_length(length: float, step: float, radius: float = EARTH_RADIUS) -> float:
    """Filter strength that halves the power at `length` metres on a grid of `step` degrees."""
    return 1.0 / math.tan(math.pi / (180.0 * length / (math.pi * radius * step))) ** 6


def strength_by_latitude(length: float, lat: Column, step_x: float, step_y: float, radius: float = EARTH_RADIUS) -> Column:
    """Strength per row that keeps the same length in metres as rows shorten towards the poles."""
    cells = 180.0 * length / (math.pi * radius * step_x)
    wave = F.lit(cells) / (F.lit(step_x / step_y) * F.abs(F.cos(F.radians(lat))))
    eps = F.least(F.lit(1.0) / F.pow(F.tan(F.lit(math.pi) / wave), F.lit(6.0)), F.lit(MAX_STRENGTH))
    return F.when(F.abs(lat) == 90, F.lit(strength_from_length(length, step_x, radius))).otherwise(eps)


def strength_isotropic(epsilon: float, row: Column, ny: int, nx: int) -> Column:
    """Strength per row number for a strength given at the equator of a global ny by nx grid."""
    cells = 2.0 * math.pi / (2.0 * math.atan(epsilon ** (-1.0 / 6.0)))
    ratio = F.lit(abs(2.0 * ny / nx)) * F.abs(F.sin((row + 0.5) * F.lit(math.pi / ny)))
    wave = F.greatest(F.lit(1.0) / ratio, F.lit(1.0)) * F.lit(cells)
    eps = F.lit(1.0) / F.pow(F.tan(F.lit(math.pi) / wave), F.lit(6.0))
    return F.least(F.when(ratio == 0, F.lit(epsilon)).otherwise(eps), F.lit(MAX_STRENGTH))


def _system(n: int, eps: np.ndarray, periodic: bool) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients per line, offset (-3..3) and position: of the unknowns, and of the data on the right-hand side.

    The order of the difference drops to 4 and 2 next to open ends, and the end points themselves do not move.
    """
    lhs, rhs = np.zeros((len(eps), 7, n)), np.zeros((len(eps), 7, n))
    for i in range(n):
        order = 3 if periodic else min(i, n - 1 - i, 3)
        if order == 0:
            lhs[:, 3, i] = 1.0
            continue
        for k, c in zip(range(-order, order + 1), STENCILS[order]):
            lhs[:, 3 + k, i] = c * (1.0 - eps if k % 2 else 1.0 + eps)
            rhs[:, 3 + k, i] = c * (eps if k % 2 else -eps)
    return lhs, rhs


def filter_lines(data: np.ndarray, eps: np.ndarray, periodic: bool) -> np.ndarray:
    """Filter each line of `data` (lines x n).  Banded elimination runs along the lines, vectorised over them."""
    n = data.shape[1]
    if n < 7:
        raise ValueError("lines of fewer than seven cells cannot be filtered")
    lhs, coef = _system(n, eps, periodic)
    g = np.zeros_like(data)
    for k in range(-3, 4):
        g += coef[:, 3 + k, :] * np.roll(data, -k, axis=1)
    if periodic:
        return data + _solve_periodic(lhs, g)
    return data + _solve_band(lhs, g[:, :, None])[:, :, 0]


def _solve_band(band: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Solve seven-diagonal systems for several right-hand sides (lines x n x sides) by elimination without pivoting."""
    a, b = band.copy(), g.copy()
    n = a.shape[2]
    for i in range(n):
        for r in range(i + 1, min(i + 4, n)):
            f = a[:, 3 - (r - i), r] / a[:, 3, i]
            for c in range(i, min(i + 4, n)):
                a[:, 3 + c - r, r] -= f * a[:, 3 + c - i, i]
            b[:, r] -= f[:, None] * b[:, i]
    for i in range(n - 1, -1, -1):
        for c in range(i + 1, min(i + 4, n)):
            b[:, i] -= a[:, 3 + c - i, i][:, None] * b[:, c]
        b[:, i] /= a[:, 3, i][:, None]
    return b


def _solve_periodic(band: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Cyclic system by bordering: the last three unknowns are split off and found from a small dense system."""
    m, _, n = band.shape
    k = n - 3
    core = band[:, :, :k].copy()
    right = np.zeros((m, k, 3))  # core rows x last unknowns
    bottom = np.zeros((m, 3, n))
    for i in range(k):
        for o in range(-3, 4):
            j = (i + o) % n
            if j >= k:
                right[:, i, j - k] += band[:, 3 + o, i]
            if i + o < 0 or i + o >= k:
                core[:, 3 + o, i] = 0.0
    for r in range(3):
        for o in range(-3, 4):
            bottom[:, r, (k + r + o) % n] += band[:, 3 + o, k + r]
    sol = _solve_band(core, np.concatenate([g[:, :k, None], right], axis=2))
    base, lift = sol[:, :, 0], sol[:, :, 1:]
    small = bottom[:, :, k:] - bottom[:, :, :k] @ lift
    rest = g[:, k:] - (bottom[:, :, :k] @ base[:, :, None])[:, :, 0]
    tail = np.linalg.solve(small, rest[:, :, None])
    return np.concatenate([base - (lift @ tail)[:, :, 0], tail[:, :, 0]], axis=1)


def _filter_along(cells: DataFrame, by: list[str], line: str, along: str, n: int, eps: Column, periodic: bool, value: str) -> DataFrame:
    """Filter every line of `n` cells.  Whole lines are grouped so that a group holds about GROUP_CELLS, at least one line."""
    per_group = max(GROUP_CELLS // n, 1)
    typed = cells.withColumn("_eps", eps.cast("double")).withColumn("_g", F.floor(F.col(line) / per_group))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cells.schema.fields)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([line, along])
        if len(pdf) % n or (pdf[along].to_numpy().reshape(-1, n) != pdf[along].to_numpy()[:n]).any():
            raise ValueError("the filter needs a field without absent cells")
        out = filter_lines(pdf[value].to_numpy(float).reshape(-1, n), pdf["_eps"].to_numpy(float)[::n], periodic)
        return pdf.assign(**{value: out.ravel()}).drop(columns=["_eps", "_g"])

    return typed.groupBy(*by, "_g").applyInPandas(solve, schema)


def raymond_filter(
    cells: DataFrame, ny: int, nx: int, epsilon: float, row_epsilon: Column | None = None, circular: bool = True, by: list[str] | None = None,
    value: str = "value", along: tuple[str, ...] = ("x", "y"),
) -> DataFrame:
    """Low-pass filter of dense fields: rows (periodic if circular, strength `row_epsilon`), then columns (`epsilon`); `along` may name one only."""
    by = by or []
    base = cells.select(*by, "y", "x", F.col(value).cast("double").alias(value))
    strength = row_epsilon if row_epsilon is not None else F.lit(epsilon)
    out = _filter_along(base, by, "y", "x", nx, strength, circular, value) if "x" in along else base
    out = _filter_along(out, by, "x", "y", ny, F.lit(epsilon), False, value) if "y" in along else out
    return out.withColumn(value, F.col(value).cast("float").cast("double"))
