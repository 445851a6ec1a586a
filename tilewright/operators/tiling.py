"""Tile grids over pages, and labels of the polygons that fall into each tile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.functions import geometry as G


def _steps(extent: Column, stride: int) -> Column:
    """0, stride, ... below the extent; no step for an extent of 0."""
    return F.when(extent > 0, F.sequence(F.lit(0), (extent - 1).cast("int"), F.lit(stride))).otherwise(F.array().cast("array<int>"))


def tile_grid(images: DataFrame, tile: int = 512, overlap: int = 64) -> DataFrame:
    """``images`` (with w, h) times their tile corners ``ty``, ``tx``."""
    if not 0 <= overlap < tile:
        raise ValueError("overlap must be at least 0 and below the tile side")
    stride = tile - overlap
    rows = images.withColumn("ty", F.explode(_steps(F.col("h"), stride)))
    return rows.withColumn("tx", F.explode(_steps(F.col("w"), stride)))


def tile_name(stem: Column) -> Column:
    """File name of a tile without its extension."""
    return F.format_string("%s_tile_r%04d_c%04d", stem, F.col("ty"), F.col("tx"))


def plan_tile_name(folder: Column) -> Column:
    """File name of a tile of a plan that is named by its folder."""
    return F.format_string("cc5k_%s_r%04d_c%04d", F.replace(folder, F.lit("/"), F.lit("_")), F.col("ty"), F.col("tx"))


def turned_tile_name(stem: Column, angle: Column) -> Column:
    """File name of a tile of a turned page."""
    return F.format_string("%s_rot%d_r%04d_c%04d", stem, angle, F.col("ty"), F.col("tx"))


def pad_extent(tiles: DataFrame, tile: int = 512) -> DataFrame:
    """Valid width and height of each tile, and the pixels that are padding."""
    valid = tiles.withColumn("valid_w", F.least(F.lit(tile), F.col("w") - F.col("tx"))).withColumn(
        "valid_h", F.least(F.lit(tile), F.col("h") - F.col("ty"))
    )
    return valid.withColumn("padded", F.lit(tile * tile) - F.col("valid_w") * F.col("valid_h"))


def overlaps(box: Column, tx: Column, ty: Column, width: Column, height: Column) -> Column:
    """Whether a polygon's box (``bounds``) and a tile's box meet; touching counts."""
    return (box["max_x"] >= tx) & (box["min_x"] <= tx + width) & (box["max_y"] >= ty) & (box["min_y"] <= ty + height)


def tiles_by_join(images: DataFrame, shapes: DataFrame, tile: int = 512, overlap: int = 64, keys: tuple[str, ...] = ("image_id",)) -> DataFrame:
    """Shapes with the tiles that they touch: an equi-join on the page, then the range test.

    Spark takes the grid to be as small as the pages that it is made of, and would
    collect it on the driver to broadcast it, so the join is told to sort and merge.
    """
    grid = tile_grid(images, tile, overlap).hint("merge")
    # Each shape's box is found once, not again for each tile of its page.
    boxed = shapes.withColumn("__box", G.bounds(F.col("polygon")))
    side = F.lit(tile)
    return grid.join(boxed, list(keys)).where(overlaps(F.col("__box"), F.col("tx"), F.col("ty"), side, side)).drop("__box")


def _hits(low: Column, high: Column, extent: Column, tile: int, stride: int, closed_edge: bool) -> Column:
    """Corners of the tiles that [low, high] touches, by arithmetic; no grid is made."""
    first = F.greatest(F.lit(0), F.ceil((low - tile) / F.lit(float(stride))))
    last = F.least(F.floor(high / F.lit(float(stride))), F.ceil(extent / F.lit(float(stride))) - 1)
    able = (first <= last) & (F.lit(True) if not closed_edge else low <= extent)
    steps = F.transform(F.sequence(first.cast("int"), last.cast("int")), lambda k: k * stride)
    return F.when(able, steps).otherwise(F.array().cast("array<int>"))


def tiles_by_explode(pages_and_shapes: DataFrame, tile: int = 512, overlap: int = 64, closed_edge: bool = False) -> DataFrame:
    """The rows of ``tiles_by_join`` without making the grid: each shape computes its tiles.

    The input has w, h and polygon. Work grows with the matches alone, and no shuffle
    is needed beyond the one that brought pages and shapes together. ``closed_edge``
    ends the last tiles at the page's edge, which shapes beyond it don't touch.
    """
    stride = tile - overlap
    b = G.bounds(F.col("polygon"))
    rows = pages_and_shapes.withColumn(
        "ty", F.explode(_hits(b["min_y"], b["max_y"], F.col("h"), tile, stride, closed_edge))
    )
    return rows.withColumn("tx", F.explode(_hits(b["min_x"], b["max_x"], F.col("w"), tile, stride, closed_edge)))


def clipped(tiles: DataFrame, tile: int = 512, least: float = 3.0) -> DataFrame:
    """Polygons clamped into their tile as ``clip``; those below ``least`` pixels either way go."""
    side = F.lit(float(tile))
    rows = tiles.withColumn("clip", G.clamped(F.col("polygon"), F.col("tx"), F.col("ty"), side, side))
    b = G.bounds(F.col("clip"))
    return rows.where((b["max_x"] - b["min_x"] >= least) & (b["max_y"] - b["min_y"] >= least))


def label_text(rows: DataFrame, keys: list[str], order: list[str], line: str = "line", trailing_newline: bool = True) -> DataFrame:
    """Label lines of each key joined in order, as one text; a key's lines fit one tile's label."""
    gathered = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*order, line))).alias("__lines"))
    text = F.array_join(F.col(f"__lines.{line}"), "\n")
    return gathered.select(*keys, F.size("__lines").alias("n_labels"), (F.concat(text, F.lit("\n")) if trailing_newline else text).alias("label"))
