"""Labels and sentences of the report. Survey ids stand in brackets."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# fixed values: names of the platforms and months
PLATFORMS = {"landsat-5": "Landsat 5", "landsat-7": "Landsat 7", "landsat-8": "Landsat 8", "landsat-9": "Landsat 9"}
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def platform_label(sensor: Column, platforms: Column) -> Column:
    """[P29]"""
    names = F.create_map(*(F.lit(x) for kv in PLATFORMS.items() for x in kv))
    joined = F.array_join(F.transform(platforms, lambda p: F.coalesce(F.try_element_at(names, p), p)), " / ")
    return F.when(sensor == "sentinel-2", "Sentinel-2").otherwise(joined)


def year_label(years: Column) -> Column:
    """[P30] first to last year, or the only one."""
    low, high = F.array_min(years).cast("string"), F.array_max(years).cast("string")
    return F.when(low == high, low).otherwise(F.concat(low, F.lit("-"), high))


def month_label(first: Column, last: Column) -> Column:
    """[P30]"""
    names = F.array(*map(F.lit, MONTHS))
    return F.concat(F.try_element_at(names, first), F.lit("-"), F.try_element_at(names, last))


def hectares_or_none(ha: Column) -> Column:
    """[P36] nothing where unknown, "almost none" under half a hectare, else whole hectares."""
    return F.when(ha.isNull(), F.lit(None)).when(ha < 0.5, "almost none").otherwise(F.concat(F.round(ha).cast("bigint").cast("string"), F.lit(" ha")))


def distance_clause(km: Column, buffer_km: Column) -> Column:
    """Where the footprint lies: inside, within the buffer, or beyond it."""
    return F.when(km.isNull(), F.lit(None)).when(km == 0, "inside").when(km <= F.coalesce(buffer_km, F.lit(0.0)), "within the buffer").otherwise("beyond the buffer")


def zoom(box_km: Column) -> Column:
    """Map zoom at which a box fits on screen."""
    return F.when(box_km <= 5, 15).when(box_km <= 10, 14).otherwise(13)


def tick_step(top: Column) -> Column:
    """Step of a chart's axis by its top value."""
    return F.when(top > 150, 50).when(top > 60, 20).when(top > 20, 10).otherwise(5)


def partial_date_ok(text: Column) -> Column:
    """[D2] YYYY, YYYY-MM or YYYY-MM-DD."""
    return text.rlike(r"^\d{4}(-\d{2}(-\d{2})?)?$")
