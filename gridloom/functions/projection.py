"""Coordinate transforms as column expressions: rotated pole and the British grid (transverse Mercator series)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_rotated(lat: Column, lon: Column, pole_lat: float, pole_lon: float) -> tuple[Column, Column]:
    """Latitude and longitude seen from a rotated pole; longitude 0 runs through the pole and its opposite meridian."""
    theta = math.radians(pole_lat)
    lam = F.radians(lon - F.lit(pole_lon) + F.lit(180.0))
    phi = F.radians(lat)
    x = F.cos(phi) * F.cos(lam) * F.lit(math.sin(theta)) + F.sin(phi) * F.lit(math.cos(theta))
    y = F.cos(phi) * F.sin(lam)
    z = F.sin(phi) * F.lit(math.sin(theta)) - F.cos(phi) * F.cos(lam) * F.lit(math.cos(theta))
    return F.degrees(F.asin(F.least(F.greatest(z, F.lit(-1.0)), F.lit(1.0)))), F.degrees(F.atan2(y, x))


def from_rotated(rlat: Column, rlon: Column, pole_lat: float, pole_lon: float) -> tuple[Column, Column]:
    """True latitude and longitude of a point given in the rotated system."""
    theta = math.radians(pole_lat)
    lam, phi = F.radians(rlon), F.radians(rlat)
    x = F.cos(phi) * F.cos(lam) * F.lit(math.sin(theta)) - F.sin(phi) * F.lit(math.cos(theta))
    y = F.cos(phi) * F.sin(lam)
    z = F.sin(phi) * F.lit(math.sin(theta)) + F.cos(phi) * F.cos(lam) * F.lit(math.cos(theta))
    lat = F.degrees(F.asin(F.least(F.greatest(z, F.lit(-1.0)), F.lit(1.0))))
    lon = F.degrees(F.atan2(y, x)) + F.lit(pole_lon - 180.0)
    return lat, F.pmod(lon + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)


# Airy 1830 ellipsoid and the British national grid.
AIRY_A, AIRY_B = 6377563.396, 6356256.909
GRID_F0, GRID_LAT0, GRID_LON0 = 0.9996012717, math.radians(49.0), math.radians(-2.0)
GRID_E0, GRID_N0 = 400000.0, -100000.0


#: A horizontal coordinate system: None is latitude and longitude, a pair the latitude and longitude of a rotated pole, "british" metres.
System = tuple[float, float] | str | None


def in_degrees(system: System) -> bool:
    return system != "british"


def _radii(phi: Column) -> tuple[Column, Column]:
    """Radii of curvature across and along the meridian, scaled to the grid."""
    e2 = 1.0 - (AIRY_B / AIRY_A) ** 2
    flat = 1 - F.lit(e2) * F.sin(phi) * F.sin(phi)
    nu = F.lit(AIRY_A * GRID_F0) / F.sqrt(flat)
    return nu, nu * F.lit(1.0 - e2) / flat


def _meridian_arc(phi: Column) -> Column:
    """Length of the meridian from the grid's true origin, scaled to the grid."""
    n = (AIRY_A - AIRY_B) / (AIRY_A + AIRY_B)
    d, s = phi - F.lit(GRID_LAT0), phi + F.lit(GRID_LAT0)
    return F.lit(AIRY_B * GRID_F0) * (
        F.lit(1 + n + 1.25 * n**2 + 1.25 * n**3) * d
        - F.lit(3 * n + 3 * n**2 + 21 / 8 * n**3) * F.sin(d) * F.cos(s)
        + F.lit(15 / 8 * (n**2 + n**3)) * F.sin(2 * d) * F.cos(2 * s)
        - F.lit(35 / 24 * n**3) * F.sin(3 * d) * F.cos(3 * s)
    )


def from_british_grid(east: Column, north: Column) -> tuple[Column, Column]:
    """Latitude and longitude on the Airy ellipsoid of an easting and northing (metres): the inverse of `to_british_grid`."""
    rise = north - F.lit(GRID_N0)
    # The latitude whose arc has the northing's length: each step gains some three digits.
    foot = F.aggregate(
        F.sequence(F.lit(1), F.lit(8)), rise / F.lit(AIRY_A * GRID_F0) + F.lit(GRID_LAT0),
        lambda phi, _: phi + (rise - _meridian_arc(phi)) / F.lit(AIRY_A * GRID_F0),
    )

    def place(phi: Column) -> Column:
        nu, rho = _radii(phi)
        eta2, t, t2 = nu / rho - 1, F.tan(phi), F.tan(phi) * F.tan(phi)
        de = east - F.lit(GRID_E0)
        lat = (
            phi
            - t / (2 * rho * nu) * F.pow(de, 2)
            + t / (24 * rho * F.pow(nu, 3)) * (5 + 3 * t2 + eta2 - 9 * t2 * eta2) * F.pow(de, 4)
            - t / (720 * rho * F.pow(nu, 5)) * (61 + 90 * t2 + 45 * t2 * t2) * F.pow(de, 6)
        )
        lon = F.lit(GRID_LON0) + (
            de / nu
            - F.pow(de, 3) / (6 * F.pow(nu, 3)) * (nu / rho + 2 * t2)
            + F.pow(de, 5) / (120 * F.pow(nu, 5)) * (5 + 28 * t2 + 24 * t2 * t2)
            - F.pow(de, 7) / (5040 * F.pow(nu, 7)) * (61 + 662 * t2 + 1320 * t2 * t2 + 720 * t2 * t2 * t2)
        ) / F.cos(phi)
        return F.struct(F.degrees(lat).alias("lat"), F.degrees(lon).alias("lon"))

    found = F.transform(F.array(foot), place)[0]
    return found["lat"], found["lon"]


def to_geographic(v: Column, u: Column, system: System) -> tuple[Column, Column]:
    """Latitude and longitude of a point given by its second and first coordinate (latitude or northing first)."""
    if system is None or system[0] == 90.0:
        return v, u
    return from_british_grid(u, v) if system == "british" else from_rotated(v, u, *system)


def from_geographic(lat: Column, lon: Column, system: System) -> tuple[Column, Column]:
    """Second and first coordinate (latitude or northing first) of a geographic point."""
    if system is None or system[0] == 90.0:
        return lat, lon
    return to_british_grid(lat, lon)[::-1] if system == "british" else to_rotated(lat, lon, *system)


def to_british_grid(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Easting and northing (metres) of a latitude and longitude on the Airy ellipsoid."""
    phi = F.radians(lat)
    nu, rho = _radii(phi)
    eta2 = nu / rho - 1
    c, t2 = F.cos(phi), F.tan(phi) * F.tan(phi)
    # Degrees from the true origin's meridian, whichever turn the longitude is given in.
    dl = F.radians(F.pmod(lon - F.lit(math.degrees(GRID_LON0)) + F.lit(180.0), F.lit(360.0)) - F.lit(180.0))
    north = (
        _meridian_arc(phi)
        + F.lit(GRID_N0)
        + nu / 2 * F.sin(phi) * c * F.pow(dl, 2)
        + nu / 24 * F.sin(phi) * F.pow(c, 3) * (5 - t2 + 9 * eta2) * F.pow(dl, 4)
        + nu / 720 * F.sin(phi) * F.pow(c, 5) * (61 - 58 * t2 + t2 * t2) * F.pow(dl, 6)
    )
    east = (
        F.lit(GRID_E0)
        + nu * c * dl
        + nu / 6 * F.pow(c, 3) * (nu / rho - t2) * F.pow(dl, 3)
        + nu / 120 * F.pow(c, 5) * (5 - 18 * t2 + t2 * t2 + 14 * eta2 - 58 * t2 * eta2) * F.pow(dl, 5)
    )
    return east, north


def bounding_box(points: DataFrame, u: Column, v: Column, by: list[str] | None = None) -> DataFrame:
    """Smallest box around transformed points, per group."""
    return points.groupBy(*(by or [])).agg(
        F.min(u).alias("u_min"), F.max(u).alias("u_max"), F.min(v).alias("v_min"), F.max(v).alias("v_max")
    )
