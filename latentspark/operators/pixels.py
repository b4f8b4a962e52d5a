"""Pixel-table operators (X4, X6): stretch an image's colours, count pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.pixels import stretch


def stretch_pixels(pixels: DataFrame) -> DataFrame:
    """X4 over a table: ``px`` replaced by its stretched value (a map, no shuffle)."""
    return pixels.withColumn("px", stretch("px"))


def pixel_counts(pixels: DataFrame) -> DataFrame:
    """Pixels per image (partial counts before the shuffle)."""
    return pixels.groupBy("image_id").agg(F.count(F.lit(1)).alias("n_pixels"))
