"""Inputs derived from the given tables, for queries and tests; no part of the engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions import geometry as G
from tilewright.operators import kernel_udfs

SIDE = 8


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of some size, one for each part."""
    k = F.col("p_partkey")
    return read(spark, sf_dir, "part").select(
        k.alias("image_id"), (300 + k * 37 % 1500).cast("int").alias("w"), (300 + k * 53 % 1500).cast("int").alias("h")
    )


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes on pages, one for each line item; ids repeat."""
    o, n = F.col("l_orderkey"), F.col("l_linenumber")
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("image_id"),
        (o * 8 + n).alias("ann_id"),
        (1 + n % 3).cast("int").alias("category_id"),
        ((o * 31 + n * 101) % 1800).cast("long").alias("x0"),
        ((o * 17 + n * 211) % 1800).cast("long").alias("y0"),
        (1 + o % 97).alias("dx"),
        (1 + o % 61).alias("dy"),
        (o % 7).alias("sx"),
        (o % 5).alias("sy"),
    )


def unique_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations with each id once, on the least of its pages."""
    return annotations(spark, sf_dir).groupBy("ann_id", "category_id", "x0", "y0", "dx", "dy", "sx", "sy").agg(
        F.min("image_id").alias("image_id")
    )


def boxes(rows: DataFrame) -> DataFrame:
    """With ``polygon``, the box."""
    x0, y0 = F.col("x0"), F.col("y0")
    return rows.withColumn("polygon", G.box_polygon(x0, y0, x0 + F.col("dx"), y0 + F.col("dy")))


def skewed(rows: DataFrame) -> DataFrame:
    """With ``polygon``, the box whose third corner is moved."""
    x0, y0 = F.col("x0"), F.col("y0")
    x1, y1 = x0 + F.col("dx"), y0 + F.col("dy")
    third = G.point(x1 + F.col("sx"), y1 + F.col("sy"))
    return rows.withColumn("polygon", F.array(G.point(x0, y0), G.point(x1, y0), third, G.point(x0, y1)))


def categories(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(0, "objects"), (1, "Walls"), (2, "door"), (3, "window")], "id int, name string")


def gray_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gray images as arrays, one for each embedding of 64 numbers."""
    e = read(spark, sf_dir, "embeddings").where(F.size("embedding") == SIDE * SIDE)
    lo, hi = F.array_min("embedding").cast("double"), F.array_max("embedding").cast("double")
    value = F.transform("embedding", lambda x: F.floor((x.cast("double") - F.col("lo")) / (F.col("hi") - F.col("lo")) * 255.0).cast("int"))
    return e.select(F.col("vec_id").alias("image_id"), "embedding", lo.alias("lo"), hi.alias("hi")).where("hi > lo").select(
        "image_id", value.alias("values")
    )


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gray images' pixel rows."""
    rows = gray_arrays(spark, sf_dir).select("image_id", F.posexplode("values").alias("p", "v"))
    return rows.select(
        "image_id", F.floor(F.col("p") / SIDE).cast("int").alias("y"), (F.col("p") % SIDE).cast("int").alias("x"), "v"
    )


def gray_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gray images as rows of bytes."""
    return kernel_udfs.gray_images(gray_arrays(spark, sf_dir), SIDE, SIDE)


def image_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gray_arrays(spark, sf_dir).select("image_id", F.lit(SIDE).alias("h"), F.lit(SIDE).alias("w"))


#: The same inputs as SQL.
SQL = {
    "v": "SELECT p_partkey AS image_id, CAST(300 + p_partkey * 37 % 1500 AS INTEGER) AS w, CAST(300 + p_partkey * 53 % 1500 AS INTEGER) AS h FROM part",
    "a": """SELECT l_partkey AS image_id, l_orderkey * 8 + l_linenumber AS ann_id, CAST(1 + l_linenumber % 3 AS INTEGER) AS category_id,
      (l_orderkey * 31 + l_linenumber * 101) % 1800 AS x0, (l_orderkey * 17 + l_linenumber * 211) % 1800 AS y0,
      1 + l_orderkey % 97 AS dx, 1 + l_orderkey % 61 AS dy, l_orderkey % 7 AS sx, l_orderkey % 5 AS sy FROM lineitem""",
    "u": "SELECT ann_id, category_id, x0, y0, dx, dy, sx, sy, min(image_id) AS image_id FROM a GROUP BY ALL",
    "t": """SELECT image_id, w, h, CAST(ty AS INTEGER) AS ty, CAST(tx AS INTEGER) AS tx
      FROM v, unnest(range(0, h, 448)) AS r(ty), unnest(range(0, w, 448)) AS c(tx)""",
    "c": "SELECT * FROM (VALUES (0, 'objects'), (1, 'Walls'), (2, 'door'), (3, 'window')) AS c(id, name)",
    "e": """SELECT vec_id AS image_id, embedding, CAST(list_min(embedding) AS DOUBLE) AS lo, CAST(list_max(embedding) AS DOUBLE) AS hi
      FROM embeddings WHERE len(embedding) = 64""",
    "px": """SELECT image_id, CAST((i - 1) // 8 AS INTEGER) AS y, CAST((i - 1) % 8 AS INTEGER) AS x,
      CAST(floor((CAST(embedding[i] AS DOUBLE) - lo) / (hi - lo) * 255.0) AS INTEGER) AS v
      FROM e, unnest(range(1, 65)) AS r(i) WHERE hi > lo""",
}
_NEEDS = {"u": "a", "t": "v", "px": "e"}


def with_inputs(names: str, body: str) -> str:
    """SQL with the named inputs before it."""
    order: list[str] = []
    for n in names.split():
        for m in (_NEEDS.get(n), n):
            if m and m not in order:
                order.append(m)
    inputs = ", ".join(f"{n} AS ({SQL[n]})" for n in order)
    return f"WITH RECURSIVE {inputs}{body}" if body.lstrip().startswith(",") else f"WITH {inputs} {body}"
