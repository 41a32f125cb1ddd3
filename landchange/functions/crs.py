"""Grids and projections as Column expressions. Survey ids stand in brackets."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# fixed values: WGS84 and Clarke 1866 ellipsoids, UTM constants, the Luzon 1911 shift in metres, the authalic radius
A84, F84 = 6378137.0, 1 / 298.257223563
A66, B66 = 6378206.4, 6356583.8
K0, FALSE_E, FALSE_N = 0.9996, 500000.0, 10000000.0
LUZON_SHIFT = (-133.0, -77.0, -51.0)
EARTH_R = 6371007.2

_N = F84 / (2 - F84)
_A = A84 / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = [_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240]
_BETA = [_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480]
_DELTA = [2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15]
_E = math.sqrt(F84 * (2 - F84))


def utm_zone(lon: Column) -> Column:
    """[G1]"""
    return (F.floor((lon + 180) / 6) + 1).cast("int")


def utm_epsg(lon: Column, lat: Column) -> Column:
    """[G1]"""
    return (F.when(lat >= 0, 32600).otherwise(32700) + utm_zone(lon)).cast("int")


def utm_forward(lon: Column, lat: Column, zone: Column) -> tuple[Column, Column]:
    """[G2] (easting, northing) in metres, Kruger series of three terms."""
    phi, lam = F.radians(lat), F.radians(lon - (zone * 6 - 183))
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - F.lit(_E) * F.atanh(F.lit(_E) * s))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    e, n = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        e = e + F.lit(a) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        n = n + F.lit(a) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return F.lit(FALSE_E) + F.lit(K0 * _A) * e, F.lit(K0 * _A) * n + F.when(lat < 0, FALSE_N).otherwise(0.0)


def utm_inverse(east: Column, north: Column, zone: Column, south: bool = False) -> tuple[Column, Column]:
    """[G3] (lon, lat) in degrees."""
    xi = (north - (FALSE_N if south else 0.0)) / F.lit(K0 * _A)
    eta = (east - FALSE_E) / F.lit(K0 * _A)
    x, y = xi, eta
    for j, b in enumerate(_BETA, 1):
        x = x - F.lit(b) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        y = y - F.lit(b) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(x) / F.cosh(y))
    phi = chi
    for j, d in enumerate(_DELTA, 1):
        phi = phi + F.lit(d) * F.sin(2 * j * chi)
    return F.degrees(F.atan2(F.sinh(y), F.cos(x))) + (zone * 6 - 183), F.degrees(phi)


def snap(x: Column, box_km: Column, pixel_m: Column) -> Column:
    """[G4] lower grid edge along one axis, half-even as in Python."""
    return F.bround((x - box_km * 500.0) / pixel_m) * pixel_m


def pixels_across(box_km: Column, pixel_m: Column) -> Column:
    """[G4]"""
    return F.bround(box_km * 1000.0 / pixel_m).cast("int")


def to_pixel(x: Column, y: Column, left: Column, top: Column, pixel_m: Column) -> tuple[Column, Column]:
    """[G6] fractional (column, row)."""
    return (x - left) / pixel_m, (top - y) / pixel_m


def dms(text: Column) -> Column:
    """[G10] D-M-S to degrees; 60 seconds are allowed. Text of another form is NULL."""
    part = lambda i: F.try_element_at(F.split(text, "-"), F.lit(i)).try_cast("double")
    return part(1) + part(2) / 60 + part(3) / 3600


def luzon_to_wgs84(lon: Column, lat: Column) -> tuple[Column, Column]:
    """[G9] Luzon 1911 (Clarke 1866) to WGS84, over earth-centred coordinates; five rounds settle the latitude."""
    e2 = 1 - (B66 / A66) ** 2
    phi, lam = F.radians(lat), F.radians(lon)
    nu = F.lit(A66) / F.sqrt(1 - F.lit(e2) * F.sin(phi) * F.sin(phi))
    x = nu * F.cos(phi) * F.cos(lam) + LUZON_SHIFT[0]
    y = nu * F.cos(phi) * F.sin(lam) + LUZON_SHIFT[1]
    z = nu * F.lit(1 - e2) * F.sin(phi) + LUZON_SHIFT[2]
    p, e84 = F.sqrt(x * x + y * y), F84 * (2 - F84)
    out = F.atan2(z, p * F.lit(1 - e84))
    for _ in range(5):
        nu84 = F.lit(A84) / F.sqrt(1 - F.lit(e84) * F.sin(out) * F.sin(out))
        out = F.atan2(z + F.lit(e84) * nu84 * F.sin(out), p)
    return F.degrees(F.atan2(y, x)), F.degrees(out)


def utm_pixel_ha(pixel_m: Column) -> Column:
    """[G11]"""
    return pixel_m * pixel_m / F.lit(10000.0)


def sphere_pixel_ha(lat: Column, degrees: float = 0.00025) -> Column:
    """[G11] area of a lat/lon pixel whose centre is at lat."""
    step = math.radians(degrees)
    return F.lit(EARTH_R * EARTH_R * step * step / 10000.0) * F.cos(F.radians(lat))


def tile_names(west: Column, south: Column, east: Column, north: Column) -> Column:
    """[S10] names, by their top left corner, of the 10-degree tiles that bounds meet."""
    tops = F.sequence((F.ceil(south / 10) * 10).cast("int"), (F.ceil(north / 10) * 10).cast("int"), F.lit(10))
    lefts = F.sequence((F.floor(west / 10) * 10).cast("int"), (F.floor(east / 10) * 10).cast("int"), F.lit(10))

    def name(top: Column, left: Column) -> Column:
        ns, ew = F.when(top >= 0, "N").otherwise("S"), F.when(left >= 0, "E").otherwise("W")
        return F.concat(F.lpad(F.abs(top).cast("string"), 2, "0"), ns, F.lit("_"), F.lpad(F.abs(left).cast("string"), 3, "0"), ew)

    return F.flatten(F.transform(tops, lambda t: F.transform(lefts, lambda x: name(t, x))))
