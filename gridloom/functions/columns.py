"""Scalar building blocks as column expressions: tolerant comparison, longitudes, calendars, areas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
TOLERANCE = 1e-10
RELATIVE_TOLERANCE = 1e-5
ABSOLUTE_TOLERANCE = 1e-8
EARTH_RADIUS = 6371229.0
MISSING_REAL = -32768.0 * 32768.0


def nan() -> Column:
    return F.lit(float("nan"))


def greater(a: Column, b: Column, tol: float = TOLERANCE) -> Column:
    """a > b, counting values equal within the tolerance as greater."""
    return a > b - F.lit(tol)


def less(a: Column, b: Column, tol: float = TOLERANCE) -> Column:
    return a < b + F.lit(tol)


def isclose(a: Column, b: Column, rtol: float = RELATIVE_TOLERANCE, atol: float = TOLERANCE) -> Column:
    return F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)


def allclose(a: Column, b: Column, rtol: float = TOLERANCE, atol: float = ABSOLUTE_TOLERANCE) -> Column:
    """Aggregate: are all pairs equal within the tolerances?"""
    return F.bool_and(isclose(a, b, rtol, atol))


def tolerant_key(a: Column, digits: int = 10) -> Column:
    """Join key under which values equal up to the tolerance meet; -0.0 is folded into 0.0."""
    return F.round(a, digits) + F.lit(0.0)


def tolerant_bin(a: Column, tol: float = TOLERANCE) -> Column:
    """Bin of the tolerance's width: values in one bin are equal within it, equal values lie in one bin or in two next to each other.

    Numbers beyond 2^19 are further apart than the tolerance anyway and are bins of their own, as NaN is.
    """
    return F.when(F.abs(a) < F.lit(2.0**19 * tol / TOLERANCE), F.floor(a / F.lit(tol)).cast("double")).otherwise(a + F.lit(0.0))


def wrap_lon(p: Column, base: float, period: float = 360.0, endpoint: bool = True) -> Column:
    """Longitude wrapped into [base, base + period); a point on the end stays there when `endpoint`."""
    wrapped = F.pmod(p - F.lit(base), F.lit(period)) + F.lit(base)
    if not endpoint:
        return wrapped
    end = F.lit(base + period)
    return F.when(F.abs(p - end) <= F.lit(TOLERANCE), end).otherwise(wrapped)


def calendar_fields(days: Column, calendar: str, origin_year: int) -> Column:
    """struct(year, month, day) of `days since origin_year-01-01` in a 360 or 365 day calendar."""
    whole = F.floor(days)
    if calendar == "360_day":
        doy = F.pmod(whole, F.lit(360))
        year = F.lit(origin_year) + F.floor(whole / 360)
        month, day = F.floor(doy / 30) + 1, F.pmod(doy, F.lit(30)) + 1
    elif calendar == "365_day":
        doy = F.pmod(whole, F.lit(365))
        year = F.lit(origin_year) + F.floor(whole / 365)
        # Days before each month of a 365 day year.
        before = [0, 31, 59, 90, 120, 151, 181, 212, 243, 273, 304, 334]
        month = sum((F.when(doy >= b, 1).otherwise(0) for b in before), F.lit(0))
        day = doy - F.element_at(F.array(*[F.lit(b) for b in before]), month.cast("int")) + 1
    else:
        raise ValueError(f"calendar {calendar} keeps a timestamp column instead")
    return F.struct(year.cast("int").alias("year"), month.cast("int").alias("month"), day.cast("int").alias("day"))


def year_of(days: Column, project: str) -> Column:
    """Year of a time position: historical files count 365.24 days a year from 0, scenario files 365 from 1850."""
    if project == "historical":
        return F.floor(days / F.lit(365.24)).cast("int")
    if project == "scenario":
        return F.floor(F.lit(1850) + days / F.lit(365.0)).cast("int")
    raise ValueError("project is either 'historical' or 'scenario'")


def cell_area(y_lo: Column, y_hi: Column, x_lo: Column, x_hi: Column, radius: float = EARTH_RADIUS) -> Column:
    """Area of a latitude-longitude cell (degrees) on a sphere."""
    band = F.sin(F.radians(y_hi)) - F.sin(F.radians(y_lo))
    return F.lit(radius * radius) * F.abs(band) * F.radians(F.abs(x_hi - x_lo))


def clip_negative(v: Column) -> Column:
    """Negative values to zero; NULL and NaN stay."""
    return F.when(v < 0, F.lit(0.0)).otherwise(v)


def sentinel(v: Column, fill: float = MISSING_REAL) -> Column:
    """Masked values to the sentinel a file format wants; NaN is no mask and stays."""
    return F.coalesce(v, F.lit(fill))


def search_distance(sequence: Column, scaling: float) -> Column:
    """Search radius in ocean cells for a drainage sequence number, linear between a small and a large radius."""
    # Radii 32 and 3 and sequence 34 at a scaling of 1.
    largest, smallest, reference = round(32 * scaling), round(3 * scaling), round(34 * scaling)
    gradient = (largest - smallest) / reference
    raw = F.ceil(F.lit(gradient) * sequence + F.lit(float(smallest)))
    return F.least(F.greatest(raw, F.lit(smallest)), F.lit(largest)).cast("int")


# Molar mass relative to air, and unit of the source, per gas.
GAS_FACTORS = {
    "CO2": (1.5188, 1.0e-6),
    "CH4": (0.5523, 1.0e-9),
    "N2O": (1.5188, 1.0e-9),
    "CFC12": (4.1783, 1.0e-12),
    "HFC134A": (3.5219, 1.0e-12),
}


def mass_mixing_ratio(gas: Column, mole_fraction: Column) -> Column:
    """Mole fraction to mass mixing ratio; unknown gases give NULL."""
    factor = F.lit(None).cast("double")
    for name, (mass, unit) in GAS_FACTORS.items():
        factor = F.when(gas == name, mole_fraction * F.lit(mass) * F.lit(unit)).otherwise(factor)
    return factor
