"""Readers of annotation documents, drawings, label files, lists and images."""

from __future__ import annotations

import re
from xml.parsers import expat

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilewright.functions.geometry import point

COCO = (
    "categories array<struct<id:int,name:string>>, images array<struct<id:long,file_name:string>>, "
    "annotations array<struct<image_id:long,category_id:int,segmentation:array<array<double>>>>"
)
FLOORS = (
    "floors array<struct<id:long,rects:array<struct<id:long,points:array<struct<x:double,y:double>>>>,"
    "slabs:array<struct<id:long,points:array<struct<x:double,y:double>>>>>>"
)
#: Groups of a drawing whose polygons are walls (fixed values).
WALL_GROUPS = ("Wall", "Railing")


def coco_tables(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Categories, images and annotations (one polygon a row) of documents of schema COCO."""
    categories = docs.select(F.explode("categories").alias("c")).select("c.*")
    images = docs.select(F.explode("images").alias("i")).select(F.col("i.id").alias("image_id"), "i.file_name")
    shapes = docs.select(F.posexplode("annotations").alias("ann", "a")).select("ann", "a.*")
    rings = shapes.select("ann", "image_id", "category_id", F.posexplode("segmentation").alias("ring", "flat"))
    return categories, images, rings.select("ann", "image_id", "category_id", "ring", ring_polygon(F.col("flat")).alias("polygon"))


def ring_polygon(flat: Column) -> Column:
    """x0, y0, x1, y1, ... as a polygon; a lone last number is dropped."""
    n = F.floor(F.size(flat) / 2).cast("int")
    places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: point(F.get(flat, 2 * i), F.get(flat, 2 * i + 1)))


def read_coco(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three tables of annotation files."""
    return coco_tables(spark.read.schema(COCO).option("multiLine", True).json(path))


def read_floors(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Rects and slabs (floor_id, id, polygon) of floor files."""
    floors = spark.read.schema(FLOORS).option("multiLine", True).json(path).select(F.explode("floors").alias("f")).select("f.*")

    def of(kind: str) -> DataFrame:
        rows = floors.select(F.col("id").alias("floor_id"), F.explode(kind).alias("o"))
        return rows.select("floor_id", F.col("o.id").alias("object_id"), F.col("o.points").alias("polygon"))

    return of("rects"), of("slabs")


@F.pandas_udf(T.StringType())
def _xml_error(texts: pd.Series) -> pd.Series:
    """Why a text is no XML; null if it is."""

    def why(text: str | None) -> str | None:
        if text is None:
            return "no drawing"
        try:
            expat.ParserCreate().Parse(text, True)
        except (expat.ExpatError, ValueError) as error:
            return f"no XML: {error}"
        return None

    return pd.Series([why(t) for t in texts], dtype=object)


def _once(value: Column, then) -> Column:
    """``then`` of a value that is computed once however often ``then`` uses it."""
    return F.transform(F.array(value), then)[0]


def _wall_points(svg: str) -> Column:
    """The wall polygons' texts of a drawing; null if it has an ``error``."""
    named = " or ".join(f'@id="{g}"' for g in WALL_GROUPS)
    return F.when(F.col("error").isNull(), F.expr(f"xpath({svg}, '//g[{named}]/polygon[1]/@points')"))


def _bad_point(points: Column) -> Column:
    """Whether a pair among the texts is not two numbers."""

    def bad(text: Column) -> Column:
        pairs = F.filter(F.transform(F.split(F.trim(text), r"\s+"), lambda t: F.split(t, ",")), lambda p: F.size(p) == 2)
        return F.exists(pairs, lambda p: p[0].try_cast("double").isNull() | p[1].try_cast("double").isNull())

    return F.coalesce(F.exists(points, bad), F.lit(False))


def svg_errors(drawings: DataFrame, svg: str = "svg") -> DataFrame:
    """The drawings that have no walls for a fault, without their text, and ``error``."""
    rows = drawings.withColumn("error", _xml_error(svg))
    wrong = _once(_wall_points(svg), lambda p: F.when(_bad_point(p), F.lit("a point is not two numbers")))
    return rows.withColumn("error", F.coalesce(F.col("error"), wrong)).where("error is not null").drop(svg)


def svg_walls(drawings: DataFrame, svg: str = "svg", least: float = 4.0) -> DataFrame:
    """``wall`` (number) and ``polygon`` of the wall polygons of drawings.

    The first polygon of each wall group; points that are not pairs are skipped; walls
    of less than three points or ``least`` pixels either way go. A drawing that is null, no
    XML, or has a pair that is not two numbers has no walls; ``svg_errors`` says why.
    """
    checked = drawings.withColumn("error", _xml_error(svg))
    points = _once(_wall_points(svg), lambda p: F.when(~_bad_point(p), p))
    # Outer, as filters that Spark infers from a plain posexplode would parse each drawing again.
    rows = checked.select("*", F.posexplode_outer(points).alias("wall", "text")).drop("error", svg).where("text is not null")
    pairs = F.filter(F.transform(F.split(F.trim("text"), r"\s+"), lambda t: F.split(t, ",")), lambda p: F.size(p) == 2)
    polygon = F.transform(pairs, lambda p: point(p[0].try_cast("double"), p[1].try_cast("double")))
    rows = rows.withColumn("polygon", polygon).drop("text").where(F.size("polygon") >= 3)
    wide = F.array_max(F.transform("polygon", lambda p: p["x"])) - F.array_min(F.transform("polygon", lambda p: p["x"]))
    high = F.array_max(F.transform("polygon", lambda p: p["y"])) - F.array_min(F.transform("polygon", lambda p: p["y"]))
    return rows.where((wide >= least) & (high >= least))


def read_svg(spark: SparkSession, path: str) -> DataFrame:
    """Walls of drawing files, with the file's ``path``."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.svg")
    return svg_walls(files.select(F.input_file_name().alias("path"), F.col("value").alias("svg")))


def _label_tokens(lines: DataFrame, line: str) -> DataFrame:
    """Lines with seven tokens at least, split."""
    tokens = lines.withColumn("__t", F.filter(F.split(F.trim(line), r"\s+"), lambda t: t != ""))
    return tokens.where(F.size("__t") >= 7)


def label_polygons(lines: DataFrame, line: str = "line", strict: bool = True) -> DataFrame:
    """``class_id`` and ``points`` (whole pixels) of label lines of a w x h image.

    Strict: an odd number of coordinates drops the line; pixels are rounded half to
    even and clamped to the image. Lenient: a lone last number is ignored; pixels are
    truncated and not clamped. Lines of less than seven tokens go in either form, and so
    do lines with a token that is no number (or, for the class, no 32-bit one).
    """
    rows = _label_tokens(lines, line)
    coords = F.transform(F.slice("__t", 2, F.size("__t") - 1), lambda t: t.try_cast("double"))
    number = F.get("__t", F.lit(0)).try_cast("double").try_cast("int")
    whole = _once(coords, lambda v: F.when(F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < 1e6)), v))
    # Exploded, as a filter on a plain column would be pushed down and compute the numbers twice.
    rows = rows.withColumn("class_id", number).select("*", F.explode_outer(F.array(whole)).alias("__c"))
    rows = rows.where("class_id is not null and __c is not null")
    if strict:
        rows = rows.where(F.size("__t") % 2 == 1)

    def pixel(value: Column, extent: Column) -> Column:
        if not strict:
            return (value * extent).cast("int")
        return F.bround(F.greatest(F.lit(0.0), F.least((extent - 1).cast("double"), value * extent)), 0).cast("int")

    places = F.sequence(F.lit(0), (F.floor(F.size("__c") / 2) - 1).cast("int"))
    points = F.transform(
        places,
        lambda i: F.struct(
            pixel(F.get(F.col("__c"), 2 * i), F.col("w")).alias("x"), pixel(F.get(F.col("__c"), 2 * i + 1), F.col("h")).alias("y")
        ),
    )
    # Seven tokens make three points; a filter on the points would be pushed down and compute them twice.
    return rows.withColumn("points", points).drop("__t", "__c", line)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """``name`` (file stem) and ``line`` of label files."""
    text = spark.read.text(path, recursiveFileLookup=True, pathGlobFilter="*.txt")
    return text.select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.[^./]*$", 1).alias("name"), F.col("value").alias("line"))


def split_list(lines: DataFrame, line: str = "value") -> DataFrame:
    """Folders of list files: trimmed, without blanks, a leading slash removed; repeats stay."""
    return lines.select(F.regexp_replace(F.trim(line), "^/+", "").alias("folder")).where("folder <> ''")


def read_images(spark: SparkSession, path: str, extensions: tuple[str, ...] = ("png", "jpg", "jpeg")) -> DataFrame:
    """Decoded images (path, height, width, nChannels, data) whose extension, in any case, is listed; unreadable ones go."""
    images = spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", True).load(path)
    rows = images.select("image.*").withColumnRenamed("origin", "path")
    return rows.where(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*[e.lstrip(".").lower() for e in extensions]))


def tile_places(paths: DataFrame, path: str = "path", stem: str | None = None) -> DataFrame:
    """``stem``, ``ty`` and ``tx`` of tile file names; other names go, and places beyond 32 bits. Text after the extension is accepted."""
    name = F.substring_index(path, "/", -1)
    pattern = rf"^({re.escape(stem) if stem else '.+'})_tile_r(\d+)_c(\d+)\.(?:png|jpg)"
    rows = paths.withColumn("stem", F.regexp_extract(name, pattern, 1)).where("stem <> ''")
    rows = rows.withColumn("ty", F.regexp_extract(name, pattern, 2).try_cast("int")).withColumn(
        "tx", F.regexp_extract(name, pattern, 3).try_cast("int")
    )
    return rows.where("ty is not null and tx is not null")


def list_files(spark: SparkSession, path: str, extensions: tuple[str, ...] = ("png", "jpg", "jpeg")) -> DataFrame:
    """Paths and sizes of the files below a folder whose extension, in any case, is listed; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    return files.where(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*[e.lstrip(".").lower() for e in extensions]))


def drawing_folders(spark: SparkSession, path: str, lists: DataFrame | None = None) -> DataFrame:
    """``folder`` of each drawing: those of the list files, or, if they name none, all below ``path`` that hold a model.svg."""
    if lists is not None:
        named = split_list(lists)
        if not named.isEmpty():
            return named
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "model.svg").load(path)
    root = re.escape(path.rstrip("/").rsplit("/", 1)[-1])
    return files.select(F.regexp_extract("path", rf"/{root}/(.*)/model\.svg$", 1).alias("folder")).where("folder <> ''").orderBy("folder")


def read_gray(spark: SparkSession, path: str, extensions: tuple[str, ...] = ("png", "jpg", "jpeg")) -> DataFrame:
    """Images as gray rows (path, h, w, data)."""
    from tilewright.operators import kernel_udfs

    return kernel_udfs.gray_of(read_images(spark, path, extensions))


def base_page(paths: DataFrame, path: str = "path", suffix: str = "_cropped.png") -> DataFrame:
    """First page in order of each folder whose name ends in ``suffix``, and its stem."""
    pages = paths.where(F.col(path).endswith(suffix))
    folder = F.regexp_extract(path, r"^(.*/)?[^/]*$", 1)
    first = pages.groupBy(folder.alias("folder")).agg(F.min(path).alias("page"))
    name = F.substring_index("page", "/", -1)
    return first.withColumn("stem", F.substring(name, F.lit(1), F.length(name) - len(suffix)))
