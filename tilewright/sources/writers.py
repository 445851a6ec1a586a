"""Writers of images, label files, dataset descriptors and manifests."""

from __future__ import annotations

import json
import os
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def png(image: np.ndarray, level: int = 3) -> bytes:
    """A PNG file of a gray or BGR image."""
    h, w = image.shape[:2]
    rows = image if image.ndim == 2 else image[..., ::-1]
    raw = np.concatenate([np.zeros((h, 1), dtype=np.uint8), np.ascontiguousarray(rows).reshape(h, -1)], axis=1).tobytes()

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", w, h, 8, 0 if image.ndim == 2 else 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw, level)) + chunk(b"IEND", b"")


def write_pngs(images: DataFrame, folder: str, name: str = "name") -> None:
    """A file for each image (h, w, data), in a folder that all executors mount."""

    def save(rows) -> None:
        os.makedirs(folder, exist_ok=True)
        for r in rows:
            a = np.frombuffer(r["data"], dtype=np.uint8)
            a = a.reshape(r["h"], r["w"]) if len(a) == r["h"] * r["w"] else a.reshape(r["h"], r["w"], -1)
            path = os.path.join(folder, f"{r[name]}.png")
            # A retried task replaces the file as a whole.
            with open(f"{path}.part", "wb") as f:
                f.write(png(a))
            os.replace(f"{path}.part", path)

    images.select(name, "h", "w", "data").foreachPartition(save)


def write_samples(samples: DataFrame, path: str) -> None:
    """Samples with their pixels and label, a folder for each split; labels are columns, nothing is copied or moved."""
    samples.write.mode("overwrite").partitionBy("split").parquet(path)


def descriptor(classes: DataFrame, path: str = ".", train: str = "images/train", val: str = "images/val") -> str:
    """The dataset descriptor, from a class table (class_id, name): one row for each class."""
    names = {r["class_id"]: r["name"] for r in classes.select("class_id", "name").orderBy("class_id").collect()}
    lines = [f"path: {path}", f"train: {train}", f"val: {val}", f"nc: {len(names)}", "names:"]
    return "\n".join([*lines, *(f"  {k}: {v}" for k, v in names.items())]) + "\n"


def manifest(samples: DataFrame, **config: object) -> DataFrame:
    """One row: counts of samples by split and kind, and the configuration, as JSON in ``manifest``."""
    count = samples.agg(
        F.count(F.lit(1)).alias("samples_total"),
        F.count_if(F.col("split") == "train").alias("train"),
        F.count_if(F.col("split") == "val").alias("val"),
        F.count_if(F.col("kind") == "rect").alias("rect_samples"),
        F.count_if(F.col("kind") == "slab").alias("slab_samples"),
    )
    for k, v in config.items():
        count = count.withColumn(k, F.array(*map(F.lit, v)) if isinstance(v, (list, tuple)) else F.lit(v))
    return count.select("*", F.to_json(F.struct("*")).alias("manifest"))


def preprocess_meta(source: str, mode: str, blur: int, block_size: int, c: int) -> str:
    """How a dataset was preprocessed, as JSON."""
    return json.dumps({"source_dataset": source, "mode": mode, "blur": blur, "block_size": block_size, "c": c}, indent=2)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A small text as one file, wherever Spark's file systems reach."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def summary(samples: DataFrame, *columns: str) -> DataFrame:
    """Counts of rows by some columns."""
    return samples.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
