"""Change between two composites, and sums over zones. Survey ids stand in brackets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from landchange.functions import pixels as P
from landchange.operators.mosaic import share


def hectares(flag: Column, pixel_ha: Column | float) -> Column:
    """Area of the rows for which flag holds, for one pixel size."""
    return F.count_if(flag).cast("double") * (F.lit(pixel_ha) if isinstance(pixel_ha, float) else pixel_ha)


def vegetation_to_bare(pairs: DataFrame, by: list[str], pixel_ha: float, inside: Column | None = None) -> DataFrame:
    """[P11, P12, A6, A7, A8] comparable_fraction, vegetated_before_ha, vegetation_to_bare_ha and inside_footprint_ha.

    pairs: ndvi_before, ndvi_after and land per pixel. inside: whether a pixel is in the footprint; a group of which no pixel
    has a footprint (all null) has NULL, not 0.
    """
    valid = P.comparable(F.col("ndvi_before"), F.col("ndvi_after"), F.col("land"))
    change = P.bared(F.col("ndvi_before"), F.col("ndvi_after"), valid)
    within = F.lit(None).cast("double") if inside is None else F.when(F.count(inside) > 0, hectares(change & F.coalesce(inside, F.lit(False)), pixel_ha))
    return pairs.groupBy(*by).agg(
        share(valid).alias("comparable_fraction"), hectares(P.vegetated(F.col("ndvi_before"), valid), pixel_ha).alias("vegetated_before_ha"), hectares(change, pixel_ha).alias("vegetation_to_bare_ha"), within.alias("inside_footprint_ha")
    )


def water_change(pairs: DataFrame, by: list[str], pixel_ha: float) -> DataFrame:
    """[P13-P16, A7] land_to_water_ha (on land only) and water_to_land_ha (anywhere)."""
    c = F.col
    valid = c("ndwi_before").isNotNull() & c("ndwi_after").isNotNull()
    to_water = valid & c("land") & P.dry(c("ndwi_before"), c("nir_before")) & P.water(c("ndwi_after"), c("nir_after"), c("land"))
    to_land = valid & P.water(c("ndwi_before"), c("nir_before"), c("land")) & P.dry(c("ndwi_after"), c("nir_after"))
    return pairs.groupBy(*by).agg(hectares(to_water, pixel_ha).alias("land_to_water_ha"), hectares(to_land, pixel_ha).alias("water_to_land_ha"))


def loss_by_year(layers: DataFrame, by: list[str], first: int, last: int, inside: Column | None = None) -> DataFrame:
    """[P17, P18, A10] hectares lost per calendar year, every year of first..last present, zeros included.

    layers: treecover, lossyear (years after 2000, 0 for none) and area_ha per pixel. inside restricts to a zone.
    """
    zone = layers if inside is None else layers.where(F.coalesce(inside, F.lit(False)))
    lost = zone.withColumn("year", P.counted_loss_year(F.col("lossyear"), F.col("treecover"))).where(F.col("year").between(first, last)).groupBy(*by, "year").agg(F.sum("area_ha").alias("loss_ha"))
    years = layers.select(*by).distinct().withColumn("year", F.explode(F.sequence(F.lit(first), F.lit(last))))
    return years.join(lost, [*by, "year"], "left").withColumn("loss_ha", F.coalesce("loss_ha", F.lit(0.0)))


def loss_summary(layers: DataFrame, by: list[str], first: int, last: int, inside: Column | None = None) -> DataFrame:
    """[A9, A10, A11] area_ha, tree_cover_ha, loss by year as a map of rounded values, and loss_ha, the sum of those."""
    zone = layers if inside is None else layers.where(F.coalesce(inside, F.lit(False)))
    areas = zone.groupBy(*by).agg(F.round(F.sum("area_ha"), 1).alias("area_ha"), F.round(F.sum(F.when(P.forest(F.lit(True), F.col("treecover")), F.col("area_ha")).otherwise(0.0)), 1).alias("tree_cover_ha"))
    entry = F.struct(F.col("year").cast("string").alias("key"), F.round("loss_ha", 1).alias("value"))
    years = loss_by_year(layers, by, first, last, inside).groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("loss_by_year"), F.round(F.sum(F.round("loss_ha", 1)), 1).alias("loss_ha"))
    return areas.join(years, by)


def zone_change(masks: DataFrame, zones: DataFrame, keys: list[str], by: list[str], pixel_ha: float) -> DataFrame:
    """[A12] hectares of changed pixels inside a zone and in its buffer. zones: keys, zone, inside, in_buffer."""
    joined = masks.where("changed").join(zones, keys)
    return joined.groupBy(*by, "zone").agg(hectares(F.col("inside"), pixel_ha).alias("inside_ha"), hectares(F.col("in_buffer") & ~F.col("inside"), pixel_ha).alias("buffer_ha"))
