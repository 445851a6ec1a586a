"""Kernels on whole images: one row is one image (image_id, h, w, data), in Arrow batches.

Pages are independent, so no kernel shuffles. A kernel's rows leave as columns of numpy
arrays, those of small images together; ``large`` bounds the images that a batch holds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.operators import kernels as K

#: Images in a batch for pages of full size, and rows or pixels of small images that leave together.
BATCH, ROWS = 64, 262_144
IMAGE = "image_id long, h int, w int, data binary"


def large(spark: SparkSession) -> None:
    """Set short Arrow batches for pages of full size."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))


def gray_images(pixel_arrays: DataFrame, h: int, w: int, values: str = "values") -> DataFrame:
    """Rows of IMAGE from arrays of h * w whole numbers 0..255."""
    text = F.array_join(F.transform(values, lambda v: F.lpad(F.hex(v.cast("long")), 2, "0")), "")
    return pixel_arrays.select(F.col("image_id").cast("long"), F.lit(h).alias("h"), F.lit(w).alias("w"), F.unhex(text).alias("data"))


def array_of(data: bytes, h: int, w: int) -> np.ndarray:
    """An image's array, of three channels if its bytes are as many."""
    a = np.frombuffer(data, dtype=np.uint8)
    return a.reshape(h, w) if len(a) == h * w else a.reshape(h, w, -1)


def per_image(images: DataFrame, kernel: Callable[[np.ndarray], tuple], schema: str) -> DataFrame:
    """Rows (image_id and those of ``schema``) that a kernel makes of each image, as columns of equal length.

    Images that are null, or whose bytes are not h x w or a multiple, have no rows.
    """
    names = [c.split()[0] for c in schema.split(", ")]

    def pack(held: list[tuple]) -> pd.DataFrame:
        ids, columns = zip(*held)
        out = {"image_id": np.repeat(np.array(ids, dtype=np.int64), [len(c[0]) for c in columns])}
        for name, parts in zip(names, zip(*columns)):
            out[name] = np.concatenate(parts) if isinstance(parts[0], np.ndarray) else list(chain.from_iterable(parts))
        return pd.DataFrame(out)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows = [], 0
        for b in batches:
            for r in b.itertuples():
                if r.data is None or not r.h > 0 or not r.w > 0 or not r.data or len(r.data) % (int(r.h) * int(r.w)):
                    continue
                columns = kernel(array_of(r.data, int(r.h), int(r.w)))
                if len(columns[0]):
                    held.append((r.image_id, columns))
                    rows += max(len(columns[0]), len(r.data))
                if rows >= ROWS:
                    yield pack(held)
                    held, rows = [], 0
        if held:
            yield pack(held)

    return images.select("image_id", "h", "w", "data").mapInPandas(run, f"image_id long, {schema}")


def pixel_rows(values: np.ndarray) -> tuple:
    """y, x and v of every pixel."""
    y, x = np.indices(values.shape, dtype=np.int32)
    return y.ravel(), x.ravel(), values.ravel().astype(np.int32)


def set_rows(mask: np.ndarray) -> tuple:
    """y and x of the set pixels."""
    return tuple(c.astype(np.int32) for c in np.nonzero(mask))


def of_image(image: np.ndarray) -> tuple:
    """h, w and data of one image."""
    return [image.shape[0]], [image.shape[1]], [np.ascontiguousarray(image).tobytes()]


def images_of(images: DataFrame, kernel: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Rows of IMAGE that a kernel makes of rows of IMAGE."""
    return per_image(images, lambda a: of_image(kernel(a)), "h int, w int, data binary")


def gray_of(images: DataFrame) -> DataFrame:
    """Images (any columns, with nChannels or without, and data) as gray ones."""

    @F.pandas_udf("binary")
    def gray(data: pd.Series, h: pd.Series, w: pd.Series) -> pd.Series:
        return pd.Series([K.gray(array_of(d, x, y)).tobytes() for d, x, y in zip(data, h, w)], dtype=object)

    rows = images if "h" in images.columns else images.withColumnsRenamed({"height": "h", "width": "w"})
    return rows.withColumn("data", gray("data", "h", "w")).drop("nChannels")


def dilated(images: DataFrame, above: int, radius: int) -> DataFrame:
    return per_image(images, lambda a: set_rows(K.dilate(a > above, radius)), "y int, x int")


def component_labels(images: DataFrame, above: int) -> DataFrame:
    def kernel(a: np.ndarray) -> tuple:
        labels = K.components(a > above)
        y, x = set_rows(labels > 0)
        return y, x, labels[y, x], labels[y, x] == K.largest(labels)

    return per_image(images, kernel, "y int, x int, label int, largest boolean")


def outer_inner(images: DataFrame, mask_below: int, white: int, reach: int, share: float) -> DataFrame:
    """Outer and inner pixel totals, where the mask is what isn't brighter than ``mask_below``."""

    def kernel(a: np.ndarray) -> tuple:
        outer, inner = K.outer_inner(a, a <= mask_below, white, reach, share)
        return [int(outer.sum())], [int(inner.sum())]

    return per_image(images, kernel, "outer_pixels long, inner_pixels long")


def border_rings(images: DataFrame, above: int, share: float) -> DataFrame:
    """Set pixels in the ring along the inside of the mask's box."""
    return per_image(images, lambda a: set_rows((a > above) & K.border_ring(a > above, share)), "y int, x int")


def otsu(images: DataFrame) -> DataFrame:
    return per_image(images, lambda a: ([K.otsu(a)],), "threshold int")


def adaptive(images: DataFrame, size: int, c: int) -> DataFrame:
    return per_image(images, lambda a: pixel_rows(K.adaptive_threshold(a, size, c)), "y int, x int, v int")


def blurred(images: DataFrame, size: int) -> DataFrame:
    return per_image(images, lambda a: pixel_rows(K.blur(a, size)), "y int, x int, v int")


def preprocessed(images: DataFrame, mode: str, size: int, block: int, c: int) -> DataFrame:
    return per_image(images, lambda a: pixel_rows(K.preprocessed(a, mode, size, block, c)), "y int, x int, v int")


def polygons(images: DataFrame, min_area: float, ratio: float) -> DataFrame:
    """Simplified outer borders of the dark parts of each image."""

    def kernel(a: np.ndarray) -> tuple:
        found = K.mask_polygons(K.dark_mask(a), min_area, ratio)
        return list(range(len(found))), [p.ravel().astype(float).tolist() for p in found]

    return per_image(images, kernel, "polygon int, coords array<double>")


def styled(images: DataFrame, polygons_of: Callable[[np.ndarray], list[np.ndarray]], **style: int) -> DataFrame:
    return per_image(images, lambda a: pixel_rows(K.label_styled(a, polygons_of(a), **style)), "y int, x int, v int")


def tiles(images: DataFrame, side: int, stride: int) -> DataFrame:
    """Tiles (image_id, ty, tx, data, h, w) of each image, cut where the image is."""

    def kernel(a: np.ndarray) -> tuple:
        places = [(ty, tx) for ty in range(0, a.shape[0], stride) for tx in range(0, a.shape[1], stride)]
        ty, tx = zip(*places)
        return ty, tx, [K.tile(a, y, x, side).tobytes() for y, x in places]

    cut = per_image(images, kernel, "ty int, tx int, data binary")
    return cut.withColumn("h", F.lit(side)).withColumn("w", F.lit(side))


def _ring(flat: list | np.ndarray) -> np.ndarray:
    return np.asarray(flat, dtype=np.int64).reshape(-1, 2)


def label_rings(lines: DataFrame, images: DataFrame, strict: bool = True) -> DataFrame:
    """``image_id`` and ``rings`` (arrays of x, y, ... in pixels) of the label lines (image_id, line) of images; a page's lines fit one row."""
    from tilewright.sources import readers

    sized = lines.join(images.select("image_id", "h", "w"), "image_id")
    parsed = readers.label_polygons(sized, strict=strict)
    flat = F.flatten(F.transform("points", lambda p: F.array(p["x"], p["y"])))
    return parsed.groupBy("image_id").agg(F.collect_list(flat).alias("rings"))


def styled_by_labels(images: DataFrame, lines: DataFrame, edge: int = 1, ring: int = 3, block: int = 31, c: int = 5) -> DataFrame:
    """Images (image_id, h, w, data) in the look of their label lines, one channel, and ``outcome``.

    ``processed`` images have a polygon; others stay as they are: ``skipped`` without
    any line that is not blank, ``failed`` with lines but no polygon, or unreadable.
    """
    written = lines.where(F.trim("line") != "").groupBy("image_id").agg(F.count(F.lit(1)).alias("lines"))
    rows = images.join(label_rings(lines, images), "image_id", "left").join(written, "image_id", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                rings = [] if r.rings is None else [_ring(x) for x in r.rings]
                data, outcome = r.data, "processed"
                if rings and data:
                    data = K.label_styled(array_of(data, r.h, r.w), rings, edge, ring, block, c).tobytes()
                else:
                    outcome = "failed" if r.lines == r.lines and r.lines else "skipped"
                one = [(r.image_id, r.h, r.w, data, outcome)]
                yield pd.DataFrame(one, columns=["image_id", "h", "w", "data", "outcome"])

    return rows.select("image_id", "h", "w", "data", "rings", "lines").mapInPandas(run, f"{IMAGE}, outcome string")


#: Outcomes of a pass over images (fixed values).
OUTCOMES = ("processed", "skipped", "failed")


def outcome_counts(rows: DataFrame) -> DataFrame:
    """One row: images of each outcome, zero where there are none."""
    return rows.select(*[F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES])


def drawn(images: DataFrame, lines: DataFrame) -> DataFrame:
    """Images with their label lines drawn on them; images without a label line go."""
    rows = images.join(label_rings(lines, images, strict=False), "image_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                out = K.labelled(array_of(r.data, r.h, r.w), [_ring(x) for x in r.rings])
                yield pd.DataFrame([(r.image_id, r.h, r.w, out.tobytes())], columns=["image_id", "h", "w", "data"])

    return rows.select("image_id", "h", "w", "data", "rings").mapInPandas(run, IMAGE)
