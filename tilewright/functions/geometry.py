"""Column functions on polygons: arrays of ``struct<x:double,y:double>``."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

POLYGON = "array<struct<x:double,y:double>>"


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def box_polygon(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """An axis-parallel ring from its corners."""
    return F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1))


def xs(polygon: Column) -> Column:
    return F.transform(polygon, lambda p: p["x"])


def ys(polygon: Column) -> Column:
    return F.transform(polygon, lambda p: p["y"])


def bounds(polygon: Column) -> Column:
    """Struct of min_x, min_y, max_x, max_y."""
    return F.struct(
        F.array_min(xs(polygon)).alias("min_x"),
        F.array_min(ys(polygon)).alias("min_y"),
        F.array_max(xs(polygon)).alias("max_x"),
        F.array_max(ys(polygon)).alias("max_y"),
    )


def rotated(polygon: Column, angle: Column, w: Column, h: Column) -> Column:
    """Vertices after a turn of 90, 180 or 270 degrees of a w x h page; any other angle keeps them."""
    return F.transform(
        polygon,
        lambda p: F.when(angle == 90, point(h - p["y"], p["x"]))
        .when(angle == 180, point(w - p["x"], h - p["y"]))
        .when(angle == 270, point(p["y"], w - p["x"]))
        .otherwise(point(p["x"], p["y"])),
    )


def scaled(polygon: Column, by_x: Column, by_y: Column) -> Column:
    return F.transform(polygon, lambda p: point(p["x"] * by_x, p["y"] * by_y))


def clamped(polygon: Column, tx: Column, ty: Column, width: Column, height: Column) -> Column:
    """Vertices relative to a tile's corner, each clamped into the tile."""
    zero = F.lit(0.0)
    return F.transform(
        polygon,
        lambda p: point(F.greatest(zero, F.least(width, p["x"] - tx)), F.greatest(zero, F.least(height, p["y"] - ty))),
    )


def _following(polygon: Column) -> Column:
    """The ring turned by one vertex, so that element i is the successor of vertex i."""
    return F.concat(F.slice(polygon, 2, F.greatest(F.size(polygon) - 1, F.lit(0))), F.slice(polygon, 1, 1))


def area(polygon: Column) -> Column:
    """Area of a closed ring (shoelace formula)."""
    cross = F.zip_with(polygon, _following(polygon), lambda a, b: a["x"] * b["y"] - b["x"] * a["y"])
    return F.abs(F.aggregate(cross, F.lit(0.0), lambda s, v: s + v)) / 2


def perimeter(polygon: Column) -> Column:
    """Length of a closed ring."""
    side = F.zip_with(polygon, _following(polygon), lambda a, b: F.sqrt(F.pow(a["x"] - b["x"], 2) + F.pow(a["y"] - b["y"], 2)))
    return F.aggregate(side, F.lit(0.0), lambda s, v: s + v)


def coordinates(polygon: Column) -> Column:
    """x and y in turn, as label lines have them."""
    return F.flatten(F.transform(polygon, lambda p: F.array(p["x"], p["y"])))


def tile_label_line(class_id: Column, polygon: Column, tile: int) -> Column:
    """A label line of coordinates divided by a tile side that is a power of two.

    Such quotients are exact, so rounding half to even gives the digits of exact
    formatting without leaving the JVM. Other sides need ``label_line``.
    """
    if tile & (tile - 1):
        raise ValueError("the tile side must be a power of two")
    parts = F.transform(coordinates(polygon), lambda v: F.format_string("%.6f", F.bround(v / F.lit(float(tile)), 6)))
    return F.concat_ws(" ", class_id.cast("string"), F.array_join(parts, " "))


@F.pandas_udf(T.StringType())
def _exact_line(class_id: pd.Series, flat: pd.Series) -> pd.Series:
    lines = [None if v is None or c is None else " ".join([str(int(c)), *(f"{x:.6f}" for x in v)]) for c, v in zip(class_id, flat)]
    return pd.Series(lines, dtype=object)


def label_line(class_id: Column, polygon: Column, w: Column, h: Column) -> Column:
    """A label line of coordinates divided by any width and height.

    Six decimals must round the exact binary value, which the JVM's formatter does
    not; so one Arrow batch at a time is formatted in Python.
    """
    flat = F.flatten(F.transform(polygon, lambda p: F.array(p["x"] / w, p["y"] / h)))
    return _exact_line(class_id, flat)
