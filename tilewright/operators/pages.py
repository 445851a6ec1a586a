"""Page filtering and cropping by a model's answers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.operators.kernel_udfs import IMAGE, array_of

#: Longest side of an image shown to the model, widening of its box, share of a side that counts as all (fixed values).
LONGEST, WIDEN, ALL = 1024, 20, 0.95
_BOX = r"\[\s*(\d+)\s*,\s*(\d+)\s*,\s*(\d+)\s*,\s*(\d+)\s*\]"


def kept(answer: Column) -> Column:
    """Whether an answer says yes."""
    return F.startswith(F.lower(F.trim(answer)), F.lit("y"))


def decision_log(pages: DataFrame, name: str, answer: str, crop: bool = True, out_dir: str = ".") -> DataFrame:
    """``file``, ``kept``, and ``reason`` of pages that go or ``cropped`` and ``out`` of those that stay."""
    yes = F.coalesce(kept(F.col(answer)), F.lit(False))
    return pages.select(
        F.col(name).alias("file"),
        yes.alias("kept"),
        F.when(~yes, F.lit("no floor plan")).alias("reason"),
        F.when(yes, F.lit(crop)).alias("cropped"),
        F.when(yes, F.concat(F.lit(out_dir.rstrip("/") + "/"), F.col(name))).alias("out"),
    )


def decision_counts(log: DataFrame) -> DataFrame:
    """Pages kept and skipped, one row."""
    return log.select(F.count_if("kept").alias("kept"), F.count_if(~F.col("kept")).alias("skipped"))


def shown_size(w: Column, h: Column) -> Column:
    """Width and height as shown to the model, and the factors back to the page."""
    scale = F.least(F.try_divide(F.lit(float(LONGEST)), w), F.try_divide(F.lit(float(LONGEST)), h), F.lit(1.0))
    nw, nh = (w * scale).cast("int"), (h * scale).cast("int")
    # A side that shrinks to nothing has no factor.
    return F.struct(nw.alias("nw"), nh.alias("nh"), F.try_divide(w, nw).alias("by_x"), F.try_divide(h, nh).alias("by_y"))


def answered_box(text: Column, w: Column, h: Column) -> Column:
    """The first box of four numbers of an answer, clamped to w x h; null if none, reversed or nearly all.

    Sides are compared before clamping; a box may be empty after it. Numbers have up to 38 digits.
    """
    x1, y1, x2, y2 = (F.regexp_extract(text, _BOX, i).try_cast("decimal(38,0)") for i in range(1, 5))
    fits = x1.isNotNull() & ~((x1 >= x2) | (y1 >= y2))
    cx1, cy1 = F.greatest(F.lit(0), x1), F.greatest(F.lit(0), y1)
    cx2, cy2 = F.least(w.cast("int"), x2), F.least(h.cast("int"), y2)
    whole = ((cx2 - cx1) > w * ALL) & ((cy2 - cy1) > h * ALL)
    # x1 and y1 are not clamped from above, so they may lie beyond the image; a number beyond 32 bits then is the largest.
    low = [F.least(c, F.lit(2**31 - 1)).cast("int") for c in (cx1, cy1)]
    box = F.struct(low[0].alias("x1"), low[1].alias("y1"), cx2.cast("int").alias("x2"), cy2.cast("int").alias("y2"))
    return F.when(fits & ~whole, box)


def page_box(box: Column, by_x: Column, by_y: Column, w: Column, h: Column) -> Column:
    """A box in page pixels, widened and clamped to the page."""
    zero = F.lit(0)
    return F.when(
        box.isNotNull(),
        F.struct(
            F.greatest(zero, (box["x1"] * by_x).cast("int") - WIDEN).alias("x1"),
            F.greatest(zero, (box["y1"] * by_y).cast("int") - WIDEN).alias("y1"),
            F.least(w.cast("int"), (box["x2"] * by_x).cast("int") + WIDEN).alias("x2"),
            F.least(h.cast("int"), (box["y2"] * by_y).cast("int") + WIDEN).alias("y2"),
        ),
    )


def cropped(image: np.ndarray, box: tuple[int, int, int, int] | None) -> np.ndarray:
    """The part of an image in a page box (half-open), or all of it."""
    return image if box is None else image[box[1] : box[3], box[0] : box[2]]


def cropped_pages(pages: DataFrame, answer: str = "bbox_text") -> DataFrame:
    """Pages (image_id, h, w, data) cut to the box that their answer names; without a box they stay whole."""
    rows = pages.withColumn("__s", shown_size(F.col("w"), F.col("h")))
    shown = answered_box(F.col(answer), F.col("__s.nw"), F.col("__s.nh"))
    box = page_box(shown, F.col("__s.by_x"), F.col("__s.by_y"), F.col("w"), F.col("h"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                own = None if r.x1 != r.x1 or r.x1 is None else (int(r.x1), int(r.y1), int(r.x2), int(r.y2))
                part = np.ascontiguousarray(cropped(array_of(r.data, r.h, r.w), own))
                one = [(r.image_id, part.shape[0], part.shape[1], part.tobytes())]
                yield pd.DataFrame(one, columns=["image_id", "h", "w", "data"])

    slim = rows.select("image_id", "h", "w", "data", box.alias("__b")).select("image_id", "h", "w", "data", "__b.*")
    return slim.mapInPandas(run, IMAGE)
