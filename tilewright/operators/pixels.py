"""Pixel relations: rows (image_id, y, x, v). For small images, checks and sparse masks.

Whole pages are handled as one row each by ``kernel_udfs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["image_id", "y", "x"]


def min_max(pixels: DataFrame, value: str = "v") -> DataFrame:
    """Values spread over 0..255 in each image, rounded half to even in single precision; an image of one value becomes 0."""
    ends = pixels.groupBy("image_id").agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    factor = F.lit(255.0) / (F.col("__hi") - F.col("__lo"))
    moved = F.col(value).cast("float") * factor.cast("float") + (-F.col("__lo") * factor).cast("float")
    spread = F.when(F.col("__hi") > F.col("__lo"), F.rint(moved))
    return pixels.join(ends, "image_id").withColumn(value, F.coalesce(spread, F.lit(0)).cast("int")).drop("__lo", "__hi")


def gray(pixels: DataFrame) -> DataFrame:
    """Gray values of b, g, r by whole-number weights of 14 bits."""
    v = F.shiftright(F.col("b") * 1868 + F.col("g") * 9617 + F.col("r") * 4899 + 8192, 14)
    return pixels.select(*KEY, v.cast("int").alias("v"))


def mask(pixels: DataFrame, above: int) -> DataFrame:
    """Set pixels: those above a threshold."""
    return pixels.where(F.col("v") > above).select(*KEY)


def blank_share(tiles: DataFrame, keys: list[str], pixels_of_tile: int, above: int = 240) -> DataFrame:
    """Share of near-white pixels of each tile; pixels that are missing are padding, which is white."""
    agg = tiles.groupBy(*keys).agg(F.sum((F.col("v") > above).cast("int")).alias("__white"), F.count(F.lit(1)).alias("__n"))
    share = (F.col("__white") + (F.lit(pixels_of_tile) - F.col("__n"))) / F.lit(float(pixels_of_tile))
    return agg.select(*keys, share.alias("blank_share"))


def tiles(pixels: DataFrame, sizes: DataFrame, tile: int, stride: int) -> DataFrame:
    """Pixels with each tile (ty, tx) that holds them; ``sizes`` has image_id, h, w."""
    sized = pixels.join(sizes, "image_id")

    def starts(v: str, extent: str):
        first = F.greatest(F.lit(0), F.ceil((F.col(v) - (tile - 1)) / F.lit(float(stride)))).cast("int")
        last = F.least(F.floor(F.col(v) / F.lit(float(stride))), F.ceil(F.col(extent) / F.lit(float(stride))) - 1).cast("int")
        return F.when(first <= last, F.transform(F.sequence(first, last), lambda k: k * stride)).otherwise(F.array().cast("array<int>"))

    return sized.withColumn("ty", F.explode(starts("y", "h"))).withColumn("tx", F.explode(starts("x", "w"))).drop("h", "w")


def ink_box(pixels: DataFrame, sizes: DataFrame, below: int = 230, pad: int = 20) -> DataFrame:
    """Crop box of each image: rows and columns whose ink is over a hundredth of the other side, widened; half-open.

    Ink is what isn't brighter than ``below``. An image without such rows or columns keeps its whole area.
    """
    ink = pixels.where(F.col("v") <= below)
    rows = ink.groupBy("image_id", "y").count().join(sizes, "image_id").where(F.col("count") > 0.01 * F.col("w"))
    cols = ink.groupBy("image_id", "x").count().join(sizes, "image_id").where(F.col("count") > 0.01 * F.col("h"))
    r = rows.groupBy("image_id").agg(F.min("y").alias("y1"), F.max("y").alias("y2"))
    c = cols.groupBy("image_id").agg(F.min("x").alias("x1"), F.max("x").alias("x2"))
    box = sizes.join(r, "image_id", "left").join(c, "image_id", "left")
    some = F.col("y1").isNotNull() & F.col("x1").isNotNull()
    zero = F.lit(0)
    return box.select(
        "image_id",
        F.when(some, F.greatest(zero, F.col("y1") - pad)).otherwise(zero).cast("int").alias("y1"),
        F.when(some, F.least(F.col("h"), F.col("y2") + pad)).otherwise(F.col("h")).cast("int").alias("y2"),
        F.when(some, F.greatest(zero, F.col("x1") - pad)).otherwise(zero).cast("int").alias("x1"),
        F.when(some, F.least(F.col("w"), F.col("x2") + pad)).otherwise(F.col("w")).cast("int").alias("x2"),
    )


def stitched(tile_masks: DataFrame, sizes: DataFrame) -> DataFrame:
    """Set page pixels of tile pixels (image_id, ty, tx, py, px, hit 0/1): mean over tiles above 0.3, in whole numbers."""
    placed = tile_masks.select("image_id", (F.col("ty") + F.col("py")).alias("y"), (F.col("tx") + F.col("px")).alias("x"), "hit")
    inside = placed.join(sizes, "image_id").where((F.col("y") < F.col("h")) & (F.col("x") < F.col("w")))
    mean = inside.groupBy(*KEY).agg(F.sum("hit").alias("s"), F.count(F.lit(1)).alias("n"))
    return mean.where(F.col("s") * 10 > F.col("n") * 3).select(*KEY, "s", "n")


def union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select(*KEY).union(b.select(*KEY)).distinct()


def intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.join(b.select(*KEY), KEY, "left_semi")


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.join(b.select(*KEY), KEY, "left_anti")


def set_box(mask_pixels: DataFrame) -> DataFrame:
    """Bounds of the set pixels of each image."""
    return mask_pixels.groupBy("image_id").agg(
        F.min("y").alias("y1"), F.max("y").alias("y2"), F.min("x").alias("x1"), F.max("x").alias("x2")
    )


def border_zone(mask_pixels: DataFrame, share: float = 0.05) -> DataFrame:
    """Set pixels in the ring along the inside of the mask's box; row y2 and column x2 are outside it.

    The ring is as wide as ``share`` of the shorter side, in whole pixels; a ring of no pixels has none.
    """
    box = set_box(mask_pixels)
    wide = (F.least(F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1")) * share).cast("int")
    rows = mask_pixels.join(box.withColumn("wide", wide), "image_id")
    y, x = F.col("y"), F.col("x")
    inside = (y >= F.col("y1")) & (y < F.col("y2")) & (x >= F.col("x1")) & (x < F.col("x2"))
    core = (
        (y >= F.col("y1") + F.col("wide")) & (y < F.col("y2") - F.col("wide"))
        & (x >= F.col("x1") + F.col("wide")) & (x < F.col("x2") - F.col("wide"))
    )
    return rows.where(inside & ~core).select(*KEY)


def otsu(pixels: DataFrame) -> DataFrame:
    """Threshold of each image that splits its histogram best; the least of equals."""
    hist = pixels.groupBy("image_id", "v").agg(F.count(F.lit(1)).alias("n"))
    # An image has 256 values at most.
    per = hist.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("v", "n"))).alias("h"))
    total = F.aggregate("h", F.lit(0).cast("long"), lambda s, e: s + e["n"])
    weighted = F.aggregate("h", F.lit(0).cast("long"), lambda s, e: s + e["n"] * e["v"])
    rows = per.select("image_id", total.alias("n"), weighted.alias("s"), F.explode("h").alias("e"), F.col("h").alias("h"))
    below = F.filter("h", lambda e: e["v"] <= F.col("e.v"))
    cut = rows.select(
        "image_id",
        F.col("e.v").alias("t"),
        "n",
        "s",
        F.aggregate(below, F.lit(0).cast("long"), lambda a, e: a + e["n"]).alias("n0"),
        F.aggregate(below, F.lit(0).cast("long"), lambda a, e: a + e["n"] * e["v"]).alias("s0"),
    )
    # Variance between the classes, times n squared: (s0 n - s n0)^2 / (n0 n1), exact up to one division.
    apart = F.pow((F.col("s0") * F.col("n") - F.col("s") * F.col("n0")).cast("double"), 2)
    value = F.when(F.col("n0") < F.col("n"), apart / (F.col("n0") * (F.col("n") - F.col("n0"))).cast("double")).otherwise(F.lit(0.0))
    best = cut.withColumn("value", value).groupBy("image_id").agg(F.max_by("t", F.struct("value", (-F.col("t")).alias("least"))).alias("t"))
    return best.select("image_id", F.col("t").cast("int").alias("threshold"))
