"""Samples of a segmentation dataset from floors of rects and slabs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.operators import annotations as N
from tilewright.operators import kernels as K
from tilewright.operators import numbering

#: Class of each kind of object (fixed values).
CLASSES = {"rect": 0, "slab": 1}


def objects(rects: DataFrame, slabs: DataFrame) -> DataFrame:
    """Rects and slabs (floor_id, object_id, polygon) as one table with ``kind``."""
    both = rects.withColumn("kind", F.lit("rect")).unionByName(slabs.withColumn("kind", F.lit("slab")))
    return both.select("floor_id", "object_id", "kind", "polygon")


def numbered_samples(rows: DataFrame, rotations: list[int], max_rects: int = 0, max_slabs: int = 0) -> DataFrame:
    """Every object once for each rotation, with ``idx`` (from 1, of each kind, by floor, rotation and object) and ``name``.

    The caps bound each kind's samples; 0 keeps all.
    """
    turned = N.times_rotations(rows, rotations)
    some = numbering.by_id(turned, "floor_id", ["floor_id", "angle", "object_id"], "idx", of=["kind"])
    some = some.withColumn("idx", F.col("idx") + 1)
    for kind, cap in (("rect", max_rects), ("slab", max_slabs)):
        if cap:
            some = some.where((F.col("kind") != kind) | (F.col("idx") <= cap))
    name = F.format_string("%s_floor%d_id%d_rot%d_i%04d", "kind", "floor_id", "object_id", "angle", "idx")
    return some.withColumn("name", name)


def crop_mask(points: np.ndarray, angle: int, size: int, margin: float) -> np.ndarray:
    """A size x size mask of a polygon, turned about its middle, in a window that is ``margin`` wider on each side."""
    if len(points) < 3 or not np.isfinite(points).all():
        raise ValueError("a polygon needs three finite points")
    low, high = points.min(axis=0), points.max(axis=0)
    middle, half = (low + high) / 2, float((high - low).max()) / 2 + margin
    if not 0 < half < 1e12:
        raise ValueError("the window has no extent")
    x, y = ((points - middle) / half).T
    x, y = {0: (x, y), 90: (-y, x), 180: (-x, -y), 270: (y, -x)}[angle % 360]
    pixels = np.rint((np.stack([x, -y], axis=1) + 1) / 2 * (size - 1)).astype(np.int64)
    return K.filled((size, size), [pixels])


def label_lines(mask: np.ndarray, class_id: int, min_area: float, ratio: float) -> str:
    """Label lines of a mask's parts, without a newline at the end."""
    h, w = mask.shape
    rings = K.mask_polygons(mask, min_area, ratio)
    return "\n".join(f"{class_id} " + " ".join(f"{x / w:.6f} {y / h:.6f}" for x, y in p.tolist()) for p in rings)


def samples(
    rows: DataFrame, size: int = 512, crop_length: float = 8.0, min_area: float = 25.0, ratio: float = 0.002
) -> DataFrame:
    """Numbered samples with ``h``, ``w``, ``data`` (black on white), ``label`` and ``error``.

    A sample whose crop fails has no image and no label but says why; the others are not
    touched by it. A label is empty if its mask has no polygon.
    """
    kept = ["name", "kind", "floor_id", "object_id", "angle", "idx"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                data = label = error = None
                try:
                    points = np.array([(p["x"], p["y"]) for p in (() if r.polygon is None else r.polygon)], dtype=float)
                    mask = crop_mask(points, r.angle, size, crop_length)
                    label = label_lines(mask, CLASSES[r.kind], min_area, ratio)
                    data = np.where(mask, 0, 255).astype(np.uint8).tobytes()
                except (ValueError, TypeError, KeyError) as fault:
                    error = f"{type(fault).__name__}: {fault}"
                one = [(*(getattr(r, k) for k in kept), size, size, data, label, error)]
                yield pd.DataFrame(one, columns=[*kept, "h", "w", "data", "label", "error"])

    schema = (
        "name string, kind string, floor_id long, object_id long, angle int, idx long, h int, w int, data binary, label string,"
        " error string"
    )
    return rows.select(*kept, "polygon").mapInPandas(run, schema)


def sample_counts(made: DataFrame) -> DataFrame:
    """One row: samples that were tried of each kind, saved and skipped."""
    return made.select(
        F.count_if(F.col("kind") == "rect").alias("rects"),
        F.count_if(F.col("kind") == "slab").alias("slabs"),
        F.count_if(F.col("error").isNull()).alias("saved"),
        F.count_if(F.col("error").isNotNull()).alias("skipped"),
    )
