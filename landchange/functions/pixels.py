"""Per-pixel expressions: masks, reflectance, indices, change predicates, colours. Missing is NULL, never NaN.

Survey ids stand in brackets.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# fixed values: thresholds, classes and scale factors of the sensors and the change rules
CLEAR_SCL = [2, 4, 5, 6, 7]
VEGETATED_NDVI, BARE_NDVI = 0.5, 0.3
WATER_NDWI, DRY_NDWI, WATER_NIR, DRY_NIR = 0.1, -0.1, 0.03, 0.05
FOREST_COVER = 30
OPEN_NDVI, OPEN_NDWI = 0.35, 0.1
# fixed values: class index by WorldCover code (cropland, built, bare, grass and shrub, other)
MINING_CLASS = 0
WORLDCOVER_CLASS = {40: 1, 50: 2, 60: 3, 20: 4, 30: 4, 10: 5, 90: 5, 95: 5, 100: 5}


def finite(x: Column) -> Column:
    """NULL for NaN."""
    return F.when(~F.isnan(x), x)


def clear_landsat(qa: Column) -> Column:
    """[P1] no fill, dilated cloud, cirrus, cloud or shadow bit."""
    return qa.bitwiseAND(31) == 0


def clear_s2(scl: Column) -> Column:
    """[P2]"""
    return scl.isin(CLEAR_SCL)


def reflectance_landsat(dn: Column) -> Column:
    """[P3]"""
    return dn * F.lit(2.75e-5) - F.lit(0.2)


def reflectance_s2(dn: Column, baseline: Column) -> Column:
    """[P4] offset from processing baseline 04.00 on, compared as text."""
    return (dn + F.when(F.coalesce(baseline, F.lit("00.00")) >= "04.00", -1000).otherwise(0)) / F.lit(10000.0)


def masked(value: Column, clear: Column, dn: Column) -> Column:
    """[P5]"""
    return F.when(clear & (dn != 0), value)


def norm_diff(a: Column, b: Column) -> Column:
    """[P7]"""
    return F.try_divide(a - b, a + b)


def bare_soil_index(swir: Column, red: Column, nir: Column, blue: Column) -> Column:
    """[P7]"""
    return F.try_divide((swir + red) - (nir + blue), (swir + red) + (nir + blue))


def ratio(a: Column, b: Column) -> Column:
    """[P8] iron oxide B04/B02, ferrous B11/B08, clay B11/B12."""
    return F.try_divide(a, b)


def brightness(*bands: Column) -> Column:
    """[P9]"""
    total = bands[0]
    for b in bands[1:]:
        total = total + b
    return total / F.lit(float(len(bands)))


def comparable(before: Column, after: Column, land: Column) -> Column:
    """[P11] land, with both sides seen."""
    return F.coalesce(land, F.lit(False)) & before.isNotNull() & after.isNotNull()


def vegetated(before: Column, valid: Column) -> Column:
    """[P11]"""
    return valid & F.coalesce(before >= VEGETATED_NDVI, F.lit(False))


def bared(before: Column, after: Column, valid: Column) -> Column:
    """[P12]"""
    return vegetated(before, valid) & F.coalesce(after < BARE_NDVI, F.lit(False))


def water(ndwi: Column, nir: Column, land: Column) -> Column:
    """[P13]"""
    return F.coalesce(ndwi > WATER_NDWI, F.lit(False)) | (~F.coalesce(land, F.lit(False)) & F.coalesce(nir < WATER_NIR, F.lit(False)))


def dry(ndwi: Column, nir: Column) -> Column:
    """[P14]"""
    return F.coalesce((ndwi < DRY_NDWI) & (nir >= DRY_NIR), F.lit(False))


def forest(inside: Column, cover: Column) -> Column:
    """[P17]"""
    return inside & (cover >= FOREST_COVER)


def counted_loss_year(loss: Column, cover: Column) -> Column:
    """[P18] calendar year of a counted loss, else NULL."""
    return F.when((cover >= FOREST_COVER) & (loss > 0), loss + 2000)


def open_ground(ndvi: Column, ndwi: Column, swir: Column, land: Column) -> Column:
    """[P20]"""
    seen = ndvi.isNotNull() & ndwi.isNotNull() & swir.isNotNull()
    return F.coalesce(seen & (land > 0) & (ndvi < OPEN_NDVI) & (ndwi < OPEN_NDWI), F.lit(False))


def label(open_: Column, inside: Column, near: Column, worldcover: Column) -> Column:
    """[P21] class index, -1 where unused."""
    other = F.lit(-1)
    for code, index in WORLDCOVER_CLASS.items():
        other = F.when(worldcover == code, index).otherwise(other)
    return F.when(open_ & F.coalesce(inside, F.lit(False)), MINING_CLASS).when(open_ & ~F.coalesce(near, F.lit(False)), other).otherwise(-1)


def years_since_loss(loss: Column, year: Column) -> Column:
    """[P22]"""
    return F.when(loss > 0, year - (loss + 2000)).otherwise(-1)


def decibels(power: Column) -> Column:
    """[P23] NULL where there is no positive power."""
    return F.when(power > 0, F.lit(10.0) * F.log10(power))


def bare_indicator(ndvi: Column) -> Column:
    """[P25] a missing value is not bare."""
    return F.when(ndvi < BARE_NDVI, 1.0).otherwise(0.0)


def display_stretch(x: Column, low: float = 0.0, high: float = 0.22, gamma: float = 1.4) -> Column:
    """[P27] 0..255, NULL becomes 96."""
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (x - low) / (high - low)))
    return F.when(x.isNull(), 96).otherwise(F.floor(F.round(F.pow(t, F.lit(1 / gamma)) * 255, 9))).cast("int")


def loss_colour(year: Column, first: int, last: int) -> Column:
    """[P28, P28a] (r, g, b, a) of a loss year; not lost is transparent."""
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.coalesce(year, F.lit(first)) - first) / F.lit(float(max(1, last - first)))))
    part = lambda top: F.floor(F.lit(float(top)) * (1 - t)).cast("int")
    return F.struct(F.lit(255).alias("r"), part(220).alias("g"), part(40).alias("b"), F.when(year.isNotNull(), 200).otherwise(0).alias("a"))
