"""Models behind an interface: what a model answers is a column of the table."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.operators import kernels as K
from tilewright.operators.kernel_udfs import array_of, of_image, per_image

#: Sides and confidence that a model is asked with, and that of the plain form without tracing (fixed values).
IMAGE_SIZE, CONFIDENCE, PLAIN_CONFIDENCE = 512, 0.2, 0.05
#: Share of the tiles over a pixel from which it is set (fixed value).
MEAN = 0.3


class Predictor(Protocol):
    """A segmentation model: instance masks (floats, any size) of an image, or None."""

    def __call__(self, image: np.ndarray, image_size: int, confidence: float) -> list[np.ndarray] | None: ...


def dark_parts(image: np.ndarray, image_size: int = IMAGE_SIZE, confidence: float = CONFIDENCE) -> list[np.ndarray] | None:
    """A stand-in without weights: each dark part is an instance."""
    labels = K.components(K.gray(image) < 128)
    return [(labels == k).astype(float) for k in range(1, labels.max() + 1)] or None


@lru_cache(maxsize=2)
def loaded(load: Callable[[], Predictor]) -> Predictor:
    """What ``load`` gives, once for each Python worker of an executor (``load`` is a function of a module)."""
    return load()


def stand_in() -> Predictor:
    """Loads the stand-in."""
    return dark_parts


def combined(masks: list[np.ndarray] | None, h: int, w: int) -> tuple[np.ndarray, int]:
    """The union of instance masks above a half, at the image's size, and how many there are."""
    hit = np.zeros((h, w), dtype=np.uint8)
    for m in masks or []:
        if m.shape != hit.shape:
            m = K.sampled_linear(m.astype(float), h, w)
        hit |= (m > 0.5).astype(np.uint8)
    return hit, len(masks or [])


def tile_masks(
    tiles: DataFrame, load: Callable[[], Predictor], image_size: int = IMAGE_SIZE, confidence: float = CONFIDENCE
) -> DataFrame:
    """``hits`` (0/1 bytes: the union of the instance masks above 0.5) and ``n_instances`` of tiles (image_id, ty, tx, h, w, data)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = loaded(load)
        for b in batches:
            rows = []
            for r in b.itertuples():
                hit, n = combined(model(array_of(r.data, r.h, r.w), image_size, confidence), r.h, r.w)
                rows.append((r.image_id, r.ty, r.tx, r.h, r.w, hit.tobytes(), n))
            yield pd.DataFrame(rows, columns=["image_id", "ty", "tx", "h", "w", "hits", "n_instances"])

    schema = "image_id long, ty int, tx int, h int, w int, hits binary, n_instances int"
    return tiles.select("image_id", "ty", "tx", "h", "w", "data").mapInPandas(run, schema)


def page_masks(masks: DataFrame, sizes: DataFrame) -> DataFrame:
    """``mask`` (0/1 bytes) and ``n_instances`` of each page (image_id, h, w): the mean of its tiles' hits above MEAN.

    A page's tiles meet in one group, which is as large as the page. Instances in the
    overlap of tiles count in each.
    """
    named = sizes.select("image_id", F.col("h").alias("page_h"), F.col("w").alias("page_w"))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        h, w = int(part["page_h"].iloc[0]), int(part["page_w"].iloc[0])
        total, count = np.zeros((h, w), dtype=np.float32), np.zeros((h, w), dtype=np.float32)
        for r in part.itertuples():
            high, wide = min(r.h, h - r.ty), min(r.w, w - r.tx)
            if high > 0 and wide > 0:
                total[r.ty : r.ty + high, r.tx : r.tx + wide] += array_of(r.hits, r.h, r.w)[:high, :wide]
                count[r.ty : r.ty + high, r.tx : r.tx + wide] += 1
        mask = (total / np.maximum(count, 1) > np.float32(MEAN)).astype(np.uint8)
        one = [(int(part["image_id"].iloc[0]), h, w, mask.tobytes(), int(part["n_instances"].sum()))]
        return pd.DataFrame(one, columns=["image_id", "h", "w", "mask", "n_instances"])

    rows = masks.join(named, "image_id")
    return rows.groupBy("image_id").applyInPandas(run, "image_id long, h int, w int, mask binary, n_instances long")


def image_masks(
    images: DataFrame, load: Callable[[], Predictor], image_size: int = IMAGE_SIZE, confidence: float = CONFIDENCE
) -> DataFrame:
    """``page_masks`` of images without tiles: each is one tile."""

    def kernel(a: np.ndarray) -> tuple:
        hit, n = combined(loaded(load)(a, image_size, confidence), *a.shape[:2])
        return (*of_image(hit), [n])

    return per_image(images, kernel, "h int, w int, mask binary, n_instances long")


def overlays(pages: DataFrame, masks: DataFrame, trace: bool = True, min_area: float = 200.0, ratio: float = 0.01) -> DataFrame:
    """Pages (image_id, h, w, data) with the outlines of their masks (traced, or the plain form), in BGR, and ``n_instances``."""
    rows = pages.join(masks.select("image_id", "mask", "n_instances"), "image_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                image, mask = array_of(r.data, r.h, r.w), array_of(r.mask, r.h, r.w) > 0
                out = K.overlaid(image, mask, min_area, ratio) if trace else K.overlaid_plain(image, mask)
                one = [(r.image_id, r.h, r.w, out.tobytes(), r.n_instances)]
                yield pd.DataFrame(one, columns=["image_id", "h", "w", "data", "n_instances"])

    slim = rows.select("image_id", "h", "w", "data", "mask", "n_instances")
    return slim.mapInPandas(run, "image_id long, h int, w int, data binary, n_instances long")
