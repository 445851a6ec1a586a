"""Annotation documents: class remaps, filters and the joins of pages with shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilewright.functions import geometry as G

#: Up to so many classes are broadcast; a longer class table is joined by a shuffle.
BROADCAST_CLASSES = 10_000


def class_map(categories: DataFrame, only: str | None = None) -> DataFrame:
    """``category_id``, ``name`` and dense ``class_id`` of the categories that count.

    Category 0 is the parent and doesn't count; ``only`` names the single one that does:
    the first of that name in the order of ids. That there is none is an error.
    """
    some = categories.where("id > 0")
    if only:
        some = categories.where(F.col("name") == only).orderBy("id").limit(1)
        if some.isEmpty():
            raise ValueError(f"there is no category {only!r}")
    # A class table has a row for each class of the data set, so one task orders it.
    rank = F.row_number().over(W.orderBy("id")) - 1
    return some.select(F.col("id").alias("category_id"), "name", rank.alias("class_id"))


def remapped(annotations: DataFrame, classes: DataFrame) -> DataFrame:
    """Annotations with their class; those without one go."""
    few = classes.limit(BROADCAST_CLASSES + 1).count() <= BROADCAST_CLASSES
    return annotations.join(F.broadcast(classes) if few else classes, "category_id")


def annotated_images(images: DataFrame, annotations: DataFrame) -> DataFrame:
    """Pages with their annotations; pages without any go."""
    return images.join(annotations, "image_id")


def large_enough(shapes: DataFrame, min_area: float, polygon: str = "polygon") -> DataFrame:
    """Shapes of three vertices and ``min_area`` at least, with their ``area``."""
    return shapes.withColumn("area", G.area(F.col(polygon))).where((F.size(polygon) >= 3) & (F.col("area") >= min_area))


def included(objects: DataFrame, rects: bool = True, slabs: bool = True) -> DataFrame:
    """Objects of the kinds that are wanted."""
    return objects.where(F.col("kind").isin(*[k for k, want in (("rect", rects), ("slab", slabs)) if want]))


def object_totals(objects: DataFrame) -> DataFrame:
    """Rects and slabs over all floors, one row."""
    return objects.select(F.count_if(F.col("kind") == "rect").alias("rects"), F.count_if(F.col("kind") == "slab").alias("slabs"))


def region_box(shapes: DataFrame, pad: float, polygon: str = "polygon") -> DataFrame:
    """Bounds of each shape, widened by ``pad``."""
    b = G.bounds(F.col(polygon))
    return shapes.select(
        "*",
        (b["min_x"] - pad).alias("xmin"),
        (b["max_x"] + pad).alias("xmax"),
        (b["min_y"] - pad).alias("ymin"),
        (b["max_y"] + pad).alias("ymax"),
    )


def times_rotations(rows: DataFrame, angles: list[int]) -> DataFrame:
    """Every row once for each angle."""
    if bad := [a for a in angles if a % 90]:
        raise ValueError(f"angles must be multiples of 90: {bad}")
    return rows.withColumn("angle", F.explode(F.array(*map(F.lit, angles))))


def parse_int_list(text: str) -> list[int]:
    """Integers of a comma-separated text; [0] if there are none."""
    return [int(p) for p in text.split(",") if p.strip()] or [0]
