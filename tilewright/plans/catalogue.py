"""Queries of the engine's own operators, and SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions import geometry as G
from tilewright.operators import annotations as N
from tilewright.operators import kernel_udfs as U
from tilewright.operators import datasets, models, numbering, pages, pixels, tiling
from tilewright.plans import adapters as D
from tilewright.plans.adapters import with_inputs
from tilewright.sources import readers, writers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Tile side and stride on the small gray images.
TILE, STRIDE = 4, 3


def query(sql: str | None = None):
    """Register a query under its function's name, with SQL if it has any."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# Tiles and labels -----------------------------------------------------------------------------------------------

_TOUCH = "a.x0 + a.dx >= t.tx AND a.x0 <= t.tx + 512 AND a.y0 + a.dy >= t.ty AND a.y0 <= t.ty + 512"
_TILE_LABELS = f"""SELECT image_id, ty, tx, count(*) AS n_labels, CAST(sum(cx0 + 3 * cx1 + 5 * cy0 + 7 * cy1) AS BIGINT) AS checksum
FROM (SELECT t.image_id, t.ty, t.tx, greatest(0, least(512, x0 - tx)) AS cx0, greatest(0, least(512, x0 + dx - tx)) AS cx1,
  greatest(0, least(512, y0 - ty)) AS cy0, greatest(0, least(512, y0 + dy - ty)) AS cy1
  FROM t JOIN a ON t.image_id = a.image_id AND {_TOUCH})
WHERE cx1 - cx0 >= 3 AND cy1 - cy0 >= 3 GROUP BY image_id, ty, tx"""


def _counted(clips: DataFrame) -> DataFrame:
    b = G.bounds(F.col("clip"))
    check = b["min_x"] + 3 * b["max_x"] + 5 * b["min_y"] + 7 * b["max_y"]
    return clips.groupBy("image_id", "ty", "tx").agg(
        F.count(F.lit(1)).alias("n_labels"), F.sum(check.cast("long")).alias("checksum")
    )


@query(with_inputs("v a t", _TILE_LABELS))
def tile_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of each tile; shapes compute their tiles."""
    shapes = D.images(spark, sf_dir).join(D.boxes(D.annotations(spark, sf_dir)), "image_id")
    return _counted(tiling.clipped(tiling.tiles_by_explode(shapes)))


@query(with_inputs("v a t", _TILE_LABELS))
def tile_labels_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by a join of the grid with shapes on the page and the range test."""
    joined = tiling.tiles_by_join(D.images(spark, sf_dir), D.boxes(D.annotations(spark, sf_dir)))
    return _counted(tiling.clipped(joined))


@query(with_inputs("v t", "SELECT image_id, ty, tx, printf('page%d_tile_r%04d_c%04d', image_id, ty, tx) AS name FROM t"))
def tile_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = tiling.tile_grid(D.images(spark, sf_dir))
    return grid.select("image_id", "ty", "tx", tiling.tile_name(F.concat(F.lit("page"), F.col("image_id").cast("string"))).alias("name"))


@query(with_inputs("v t", "SELECT image_id, ty, tx, least(512, w - tx) AS valid_w, least(512, h - ty) AS valid_h, 262144 - least(512, w - tx) * least(512, h - ty) AS padded FROM t"))
def tile_pad_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tiling.pad_extent(tiling.tile_grid(D.images(spark, sf_dir)))
    return rows.select("image_id", "ty", "tx", "valid_w", "valid_h", "padded")


# Annotations ----------------------------------------------------------------------------------------------------

_REMAP = "m AS (SELECT id AS category_id, name, CAST(row_number() OVER (ORDER BY id) - 1 AS INTEGER) AS class_id FROM c WHERE {})"


@query(with_inputs("v a c", ", " + _REMAP.format("id > 0") + " SELECT image_id, class_id, name, count(*) AS n FROM v JOIN a USING (image_id) JOIN m USING (category_id) GROUP BY ALL"))
def coco_join_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = N.annotated_images(D.images(spark, sf_dir), D.annotations(spark, sf_dir))
    return N.remapped(joined, N.class_map(D.categories(spark))).groupBy("image_id", "class_id", "name").agg(F.count(F.lit(1)).alias("n"))


@query(with_inputs("v a c", ", " + _REMAP.format("name = 'Walls'") + " SELECT image_id, ann_id, class_id, count(*) AS n FROM v JOIN a USING (image_id) JOIN m USING (category_id) GROUP BY ALL"))
def walls_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = N.annotated_images(D.images(spark, sf_dir), D.annotations(spark, sf_dir))
    return N.remapped(joined, N.class_map(D.categories(spark), "Walls")).groupBy("image_id", "ann_id", "class_id").agg(F.count(F.lit(1)).alias("n"))


_TURNED = """ SELECT image_id, w, h, ann_id, category_id, angle,
  CASE angle WHEN 90 THEN h - y1 WHEN 180 THEN w - x1 WHEN 270 THEN y0 ELSE x0 END AS rx0,
  CASE angle WHEN 90 THEN h - y0 WHEN 180 THEN w - x0 WHEN 270 THEN y1 ELSE x1 END AS rx1,
  CASE angle WHEN 90 THEN x0 WHEN 180 THEN h - y1 WHEN 270 THEN w - x1 ELSE y0 END AS ry0,
  CASE angle WHEN 90 THEN x1 WHEN 180 THEN h - y0 WHEN 270 THEN w - x0 ELSE y1 END AS ry1
FROM (SELECT *, x0 + dx AS x1, y0 + dy AS y1 FROM v JOIN u USING (image_id)), (VALUES (0), (90), (180), (270)) AS g(angle)"""


@query(with_inputs("v u", "SELECT image_id, ann_id, angle, CAST(rx0 AS DOUBLE) AS min_x, CAST(ry0 AS DOUBLE) AS min_y, CAST(rx1 AS DOUBLE) AS max_x, CAST(ry1 AS DOUBLE) AS max_y FROM (" + _TURNED + ")"))
def rotate_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rotated(spark, sf_dir).select("image_id", "ann_id", "angle", G.bounds(F.col("polygon")).alias("b")).select(
        "image_id", "ann_id", "angle", "b.min_x", "b.min_y", "b.max_x", "b.max_y"
    )


def _rotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.images(spark, sf_dir).join(D.boxes(D.unique_annotations(spark, sf_dir)), "image_id")
    turned = N.times_rotations(rows, [0, 90, 180, 270])
    return turned.withColumn("polygon", G.rotated(F.col("polygon"), F.col("angle"), F.col("w"), F.col("h")))


def _corners(x0: str, y0: str, x1: str, y1: str, order: str) -> str:
    return ", ' ', ".join(f"printf('%.6f', {dict(zip('abcd', (x0, y0, x1, y1)))[k]})" for k in order)


_CLIP = "greatest(0, least(512, {0} - {1})) / 512.0::DOUBLE"
_TURNED_LABELS = (
    ", r AS (" + _TURNED + """), s AS (SELECT *, CASE WHEN angle % 180 = 0 THEN w ELSE h END AS rw, CASE WHEN angle % 180 = 0 THEN h ELSE w END AS rh FROM r),
k AS (SELECT s.*, CAST(ty AS INTEGER) AS ty, CAST(tx AS INTEGER) AS tx FROM s, unnest(range(0, rh, 448)) AS p(ty), unnest(range(0, rw, 448)) AS q(tx)
  WHERE rx1 >= tx AND rx0 <= tx + 512 AND ry1 >= ty AND ry0 <= ty + 512),
l AS (SELECT image_id, angle, ty, tx, ann_id, category_id - 1 AS class_id,
  greatest(0, least(512, rx0 - tx)) AS a0, greatest(0, least(512, rx1 - tx)) AS a1, greatest(0, least(512, ry0 - ty)) AS b0, greatest(0, least(512, ry1 - ty)) AS b1 FROM k),
f AS (SELECT image_id, angle, ty, tx, ann_id, class_id || ' ' || CASE angle
    WHEN 0 THEN concat_ws(' ', x0, y0, x1, y0, x1, y1, x0, y1) WHEN 90 THEN concat_ws(' ', x1, y0, x1, y1, x0, y1, x0, y0)
    WHEN 180 THEN concat_ws(' ', x1, y1, x0, y1, x0, y0, x1, y0) ELSE concat_ws(' ', x0, y1, x0, y0, x1, y0, x1, y1) END AS line
  FROM (SELECT *, printf('%.6f', a0 / 512.0::DOUBLE) AS x0, printf('%.6f', a1 / 512.0::DOUBLE) AS x1, printf('%.6f', b0 / 512.0::DOUBLE) AS y0, printf('%.6f', b1 / 512.0::DOUBLE) AS y1
    FROM l WHERE a1 - a0 >= 3 AND b1 - b0 >= 3))
SELECT image_id, angle, ty, tx, CAST(count(*) AS INTEGER) AS n_labels, string_agg(line, chr(10) ORDER BY ann_id) || chr(10) AS label FROM f GROUP BY ALL"""
)


@query(with_inputs("v u", _TURNED_LABELS))
def rotated_tile_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label files of all tiles of all rotations."""
    rows = _rotated(spark, sf_dir)
    across = F.col("angle") % 180 == 0
    rows = rows.withColumn("rw", F.when(across, F.col("w")).otherwise(F.col("h"))).withColumn("h", F.when(across, F.col("h")).otherwise(F.col("w")))
    clips = tiling.clipped(tiling.tiles_by_explode(rows.withColumn("w", F.col("rw"))))
    lines = clips.withColumn("line", G.tile_label_line(F.col("category_id") - 1, F.col("clip"), 512))
    return tiling.label_text(lines, ["image_id", "angle", "ty", "tx"], ["ann_id"])


@query(with_inputs("u", "SELECT ann_id, CAST(0 AS INTEGER) AS wall, CAST(4 AS INTEGER) AS n_points, CAST(x0 AS DOUBLE) AS min_x, CAST(y0 AS DOUBLE) AS min_y, CAST(x0 + dx + sx AS DOUBLE) AS max_x, CAST(y0 + dy + sy AS DOUBLE) AS max_y FROM u WHERE dx + sx >= 4 AND dy + sy >= 4"))
def svg_parse_walls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Walls parsed back from drawings made of annotations, with points that are no pairs."""
    rows = D.skewed(D.unique_annotations(spark, sf_dir))
    text = F.array_join(F.transform("polygon", lambda p: F.concat(p["x"].cast("string"), F.lit(","), p["y"].cast("string"))), " ")
    svg = F.concat(
        F.lit('<svg xmlns="http://www.w3.org/2000/svg"><g id="Door"><polygon points="0,0 9,0 9,9"/></g><g id="Wall"><polygon points="'),
        text, F.lit(' 7 1,2,3"/><polygon points="0,0 50,0 50,50"/></g></svg>'),
    )
    walls = readers.svg_walls(rows.select("ann_id", svg.alias("svg")))
    b = G.bounds(F.col("polygon"))
    return walls.select("ann_id", "wall", F.size("polygon").alias("n_points"), b["min_x"].alias("min_x"), b["min_y"].alias("min_y"), b["max_x"].alias("max_x"), b["max_y"].alias("max_y"))


@query(with_inputs("v u t", """SELECT image_id, ty, tx, count(*) AS n_labels, CAST(sum(cx0 + 3 * cx1 + 5 * cy0 + 7 * cy1) AS BIGINT) AS checksum
FROM (SELECT t.image_id, ty, tx, greatest(0, least(512, x0 - tx)) AS cx0, greatest(0, least(512, x0 + dx - tx)) AS cx1,
  greatest(0, least(512, y0 - ty)) AS cy0, greatest(0, least(512, y0 + dy - ty)) AS cy1
  FROM t JOIN u ON t.image_id = u.image_id AND x0 + dx >= tx AND x0 <= least(tx + 512, w) AND y0 + dy >= ty AND y0 <= least(ty + 512, h))
WHERE cx1 - cx0 >= 3 AND cy1 - cy0 >= 3 GROUP BY image_id, ty, tx"""))
def svg_tile_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of tiles that shapes beyond the page's edge don't touch; tiles are padded, so vertices are clamped to their side."""
    rows = D.images(spark, sf_dir).join(D.boxes(D.unique_annotations(spark, sf_dir)), "image_id")
    return _counted(tiling.clipped(tiling.tiles_by_explode(rows, closed_edge=True)))


@query(with_inputs("v u", "SELECT u.image_id, ann_id, CASE WHEN w % 2 = 0 THEN x0 * (w * 2 / CAST(w AS DOUBLE)) ELSE CAST(x0 AS DOUBLE) END AS min_x, CASE WHEN w % 2 = 0 THEN (y0 + dy) * (h * 3 / CAST(h AS DOUBLE)) ELSE CAST(y0 + dy AS DOUBLE) END AS max_y FROM u JOIN v ON u.image_id = v.image_id"))
def scale_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygons in the pixels of the original page, where there is one."""
    scaled = D.images(spark, sf_dir)
    original = scaled.where("w % 2 = 0").select("image_id", (F.col("w") * 2).alias("ow"), (F.col("h") * 3).alias("oh"))
    rows = D.boxes(D.unique_annotations(spark, sf_dir)).join(scaled, "image_id").join(original, "image_id", "left")
    one = F.lit(1.0)
    polygon = G.scaled(F.col("polygon"), F.coalesce(F.col("ow") / F.col("w"), one), F.coalesce(F.col("oh") / F.col("h"), one))
    b = G.bounds(polygon)
    return rows.select("image_id", "ann_id", b["min_x"].alias("min_x"), b["max_y"].alias("max_y"))


_LINE = """category_id || ' ' || concat_ws(' ', printf('%.6f', x0 / CAST(w AS DOUBLE)), printf('%.6f', y0 / CAST(h AS DOUBLE)), printf('%.6f', (x0 + dx) / CAST(w AS DOUBLE)), printf('%.6f', y0 / CAST(h AS DOUBLE)),
  printf('%.6f', (x0 + dx + sx) / CAST(w AS DOUBLE)), printf('%.6f', (y0 + dy + sy) / CAST(h AS DOUBLE)), printf('%.6f', x0 / CAST(w AS DOUBLE)), printf('%.6f', (y0 + dy) / CAST(h AS DOUBLE)))"""


@query(with_inputs("v u", f"SELECT image_id, CAST(count(*) AS INTEGER) AS n_labels, string_agg({_LINE}, chr(10) ORDER BY ann_id) AS label FROM v JOIN u USING (image_id) GROUP BY image_id"))
def yolo_label_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label files of whole pages, whose sides are any numbers."""
    rows = D.images(spark, sf_dir).join(D.skewed(D.unique_annotations(spark, sf_dir)), "image_id")
    lines = rows.withColumn("line", G.label_line(F.col("category_id"), F.col("polygon"), F.col("w"), F.col("h")))
    return tiling.label_text(lines, ["image_id"], ["ann_id"], trailing_newline=False)


def _label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of some pages, among them short ones, ones with an odd number and values out of range."""
    rows = D.unique_annotations(spark, sf_dir)
    v = [(F.col(c) / F.lit(1024.0)).cast("string") for c in ("x0", "y0", "dx", "dy")]
    whole = F.concat_ws(" ", (F.col("ann_id") % 4).cast("string"), *v, *v)
    short, odd = F.concat_ws(" ", F.lit("1"), *v), F.concat_ws(" ", F.lit("  2"), *v, v[0], v[1], v[2])
    kind = F.col("ann_id") % 3
    line = F.when(kind == 0, whole).when(kind == 1, odd).otherwise(F.when(F.col("ann_id") % 2 == 0, short).otherwise(F.concat(whole, F.lit(" "))))
    return rows.select("ann_id", line.alias("line"), F.lit(640).alias("w"), F.lit(480).alias("h"))


def _points(rows: DataFrame) -> DataFrame:
    total = F.aggregate("points", F.lit(0).cast("long"), lambda s, p: s * 3 + p["x"] * 7 + p["y"])
    return rows.select("ann_id", "class_id", F.size("points").alias("n_points"), total.alias("checksum"))


_KINDS = """, q AS (SELECT *, ann_id % 3 = 0 OR (ann_id % 3 = 2 AND ann_id % 2 = 1) AS whole, ann_id % 3 = 1 AS odd FROM u),
p AS (SELECT ann_id, whole, odd, {0} AS px, {1} AS py, {2} AS qx, {3} AS qy FROM q WHERE whole OR odd)
SELECT ann_id, CAST(CASE WHEN whole THEN ann_id % 4 ELSE 2 END AS INTEGER) AS class_id, CAST(CASE WHEN whole THEN 4 ELSE 3 END AS INTEGER) AS n_points,
  CAST(CASE WHEN whole THEN 27 * (px * 7 + py) + 9 * (qx * 7 + qy) + 3 * (px * 7 + py) + qx * 7 + qy ELSE 9 * (px * 7 + py) + 3 * (qx * 7 + qy) + px * 7 + py END AS BIGINT) AS checksum
FROM p"""


@query(with_inputs("u", _KINDS.format(*[f"CAST(round_even(greatest(0, least({m}, {c} / 1024.0::DOUBLE * {e})), 0) AS BIGINT)" for c, e, m in (("x0", 640, 639), ("y0", 480, 479), ("dx", 640, 639), ("dy", 480, 479))]) + " WHERE whole"))
def yolo_label_parse_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _points(readers.label_polygons(_label_lines(spark, sf_dir), strict=True))


@query(with_inputs("u", _KINDS.format(*[f"CAST(trunc({c} / 1024.0::DOUBLE * {e}) AS BIGINT)" for c, e in (("x0", 640), ("y0", 480), ("dx", 640), ("dy", 480))])))
def yolo_label_parse_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _points(readers.label_polygons(_label_lines(spark, sf_dir), strict=False))


@query(with_inputs("u", """SELECT ann_id, area, round(dx + sqrt(sx * sx + (dy + sy) * (dy + sy)::DOUBLE) + sqrt((dx + sx) * (dx + sx) + sy * sy::DOUBLE) + dy, 6) AS perimeter
FROM (SELECT *, abs((x0 * y0 - (x0 + dx) * y0) + ((x0 + dx) * (y0 + dy + sy) - (x0 + dx + sx) * y0) + ((x0 + dx + sx) * (y0 + dy) - x0 * (y0 + dy + sy)) + (x0 * y0 - x0 * (y0 + dy))) / 2.0::DOUBLE AS area FROM u) WHERE area >= 25"""))
def polygon_area_perimeter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = N.large_enough(D.skewed(D.unique_annotations(spark, sf_dir)), 25.0)
    return rows.select("ann_id", "area", F.round(G.perimeter(F.col("polygon")), 6).alias("perimeter"))


@query(with_inputs("u", "SELECT ann_id, x0 - 1.5::DOUBLE AS xmin, x0 + dx + sx + 1.5::DOUBLE AS xmax, y0 - 1.5::DOUBLE AS ymin, y0 + dy + sy + 1.5::DOUBLE AS ymax FROM u"))
def object_bbox_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.region_box(D.skewed(D.unique_annotations(spark, sf_dir)), 1.5).select("ann_id", "xmin", "xmax", "ymin", "ymax")


# Numbers, caps and splits ---------------------------------------------------------------------------------------


@query(with_inputs("u", """SELECT ann_id, angle, idx, printf('%s_floor%d_id%d_rot%d_i%04d', kind, image_id, ann_id, angle, idx) AS name
FROM (SELECT *, CASE WHEN category_id = 1 THEN 'rect' ELSE 'slab' END AS kind, row_number() OVER (PARTITION BY category_id = 1 ORDER BY ann_id, angle) AS idx FROM u, (VALUES (0), (90)) AS g(angle))"""))
def sample_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with a running number of each kind, from 1."""
    rows = N.times_rotations(D.unique_annotations(spark, sf_dir), N.parse_int_list("0, 90,"))
    rows = rows.withColumn("kind", F.when(F.col("category_id") == 1, "rect").otherwise("slab"))
    rows = numbering.by_id(rows, "ann_id", ["ann_id", "angle"], "idx", of=["kind"]).withColumn("idx", F.col("idx") + 1)
    name = F.format_string("%s_floor%d_id%d_rot%d_i%04d", "kind", "image_id", "ann_id", "angle", "idx")
    return rows.select("ann_id", "angle", F.col("idx").cast("long"), name.alias("name"))


@query(with_inputs("u", "SELECT ann_id, CAST(idx AS BIGINT) AS idx FROM (SELECT ann_id, row_number() OVER (ORDER BY ann_id) - 1 AS idx FROM u) WHERE idx < 500"))
def max_object_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbering.capped(D.unique_annotations(spark, sf_dir), "ann_id", 500).select("ann_id", F.col("idx").cast("long"))


@query("SELECT k AS floor_id, n, CAST(running AS BIGINT) AS running FROM (SELECT k, n, sum(n) OVER (ORDER BY k) AS running FROM (SELECT l_orderkey AS k, 2 * count(*) AS n FROM lineitem GROUP BY 1)) WHERE running - n < 5000")
def floor_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Floors until their objects times two rotations reach a cap."""
    floors = D.read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("floor_id")).agg((2 * F.count(F.lit(1))).alias("n"))
    return numbering.running_cutoff(floors, "floor_id", "n", 5000).select("floor_id", "n", "running")


@query("SELECT p_partkey, CAST((row_number() OVER (ORDER BY p_partkey) - 1) % 5 AS INTEGER) AS worker FROM part")
def round_robin_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbering.round_robin(D.read(spark, sf_dir, "part").select("p_partkey"), "p_partkey", 5).select("p_partkey", "worker")


@query(with_inputs("u", "SELECT ann_id, CASE WHEN row_number() OVER (ORDER BY md5('13:' || ann_id), ann_id) <= trunc((SELECT count(*) FROM u) * 0.8::DOUBLE) THEN 'train' ELSE 'val' END AS split FROM u"))
def shuffle_prefix_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbering.prefix_split(D.unique_annotations(spark, sf_dir).select("ann_id"), "ann_id", 13, 0.8).select("ann_id", "split")


@query(with_inputs("v", "SELECT image_id, CASE WHEN CAST(('0x' || substr(md5('13:' || image_id), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE < 0.2 THEN 'val' ELSE 'train' END AS split FROM v"))
def bernoulli_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbering.bernoulli_split(D.images(spark, sf_dir), "image_id", 13, 0.2).select("image_id", "split")


@query("SELECT doc_id FROM documents JOIN labels USING (doc_id) WHERE trim(text) <> '' ORDER BY md5('42:' || doc_id), doc_id LIMIT 100")
def sample_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of a hundred labelled documents (the sample is the feature)."""
    rows = D.read(spark, sf_dir, "documents").join(D.read(spark, sf_dir, "labels"), "doc_id").where(F.trim("text") != "")
    return numbering.sample_k(rows.select("doc_id"), "doc_id", 100, 42)


@query("SELECT outcome, count(l_doc) AS n_labels, count(*) AS n FROM (SELECT l.doc_id AS l_doc, CASE WHEN l.doc_id IS NULL THEN 'skipped' WHEN quality = 1 THEN 'processed' ELSE 'failed' END AS outcome FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) GROUP BY outcome")
def image_label_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of documents with an optional label."""
    labels = D.read(spark, sf_dir, "labels").withColumnRenamed("doc_id", "l_doc")
    rows = D.read(spark, sf_dir, "documents").select("doc_id").join(labels, F.col("doc_id") == F.col("l_doc"), "left")
    outcome = F.when(F.col("l_doc").isNull(), "skipped").when(F.col("quality") == 1, "processed").otherwise("failed")
    return rows.groupBy(outcome.alias("outcome")).agg(F.count("l_doc").alias("n_labels"), F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, quality, toxic FROM documents JOIN labels USING (doc_id) WHERE trim(text) <> ''")
def image_label_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.read(spark, sf_dir, "documents").where(F.trim("text") != "").select("doc_id")
    return rows.join(D.read(spark, sf_dir, "labels"), "doc_id")


@query(with_inputs("v a", "SELECT image_id, w, h FROM v WHERE image_id % 3 <> 0 AND image_id IN (SELECT image_id FROM a)"))
def required_pair_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose drawing and image are both there, and that have annotations."""
    drawings = D.images(spark, sf_dir)
    files = drawings.where("image_id % 3 <> 0").select("image_id")
    return drawings.join(files, "image_id").join(D.annotations(spark, sf_dir).select("image_id"), "image_id", "left_semi")


@query(with_inputs("u", """, s AS (SELECT ann_id, CASE WHEN category_id = 1 THEN 'rect' ELSE 'slab' END AS kind, CASE WHEN CAST(('0x' || substr(md5('13:' || ann_id), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE < 0.2 THEN 'val' ELSE 'train' END AS split FROM u)
SELECT count(*) AS samples_total, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val, count(*) FILTER (kind = 'rect') AS rect_samples, count(*) FILTER (kind = 'slab') AS slab_samples, 512 AS image_size,
  '{"samples_total":' || count(*) || ',"train":' || count(*) FILTER (split = 'train') || ',"val":' || count(*) FILTER (split = 'val') || ',"rect_samples":' || count(*) FILTER (kind = 'rect') || ',"slab_samples":' || count(*) FILTER (kind = 'slab') || ',"image_size":512}' AS manifest FROM s"""))
def manifest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.unique_annotations(spark, sf_dir).withColumn("kind", F.when(F.col("category_id") == 1, "rect").otherwise("slab"))
    return writers.manifest(numbering.bernoulli_split(rows, "ann_id", 13, 0.2), image_size=512)


# Sources --------------------------------------------------------------------------------------------------------


@query(with_inputs("v a", "SELECT image_id, CAST(category_id AS INTEGER) AS category_id, count(*) AS n, CAST(sum(x0 + dx) AS DOUBLE) AS sum_max_x FROM v JOIN a USING (image_id) GROUP BY ALL"))
def json_annotation_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotation documents, one for each page, made as JSON and parsed back into tables."""
    a = D.boxes(D.annotations(spark, sf_dir)).join(D.images(spark, sf_dir), "image_id")
    one = F.struct("image_id", "category_id", F.array(G.coordinates(F.col("polygon"))).alias("segmentation"))
    docs = a.groupBy("image_id").agg(F.collect_list(one).alias("annotations")).select(F.to_json(F.struct("annotations")).alias("json"))
    parsed = docs.select(F.from_json("json", readers.COCO).alias("d")).select("d.*")
    _, _, shapes = readers.coco_tables(parsed)
    return shapes.groupBy("image_id", "category_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(G.bounds(F.col("polygon"))["max_x"]).alias("sum_max_x")
    )


@query(with_inputs("v t", "SELECT 'p' || image_id AS stem, ty, tx FROM t WHERE image_id % 4 <> 3"))
def tile_filename_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = tiling.tile_grid(D.images(spark, sf_dir))
    stem = F.concat(F.lit("p"), F.col("image_id").cast("string"))
    end = F.element_at(F.array(F.lit(".png"), F.lit(".jpg"), F.lit(".png.bak"), F.lit(".txt")), (F.col("image_id") % 4 + 1).cast("int"))
    paths = grid.select(F.concat(F.lit("/d/"), tiling.tile_name(stem), end).alias("path"))
    return readers.tile_places(paths).select("stem", "ty", "tx")


@query(with_inputs("v", "SELECT '/d' || image_id % 10 || '/' AS folder, min('/d' || image_id % 10 || '/p' || image_id || '_cropped.png') AS page, min('p' || image_id) AS stem FROM v WHERE image_id % 2 = 0 GROUP BY 1"))
def base_page_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("image_id").cast("string")
    end = F.when(F.col("image_id") % 2 == 0, "_cropped.png").otherwise(".png")
    paths = D.images(spark, sf_dir).select(F.concat(F.lit("/d"), (F.col("image_id") % 10).cast("string"), F.lit("/p"), k, end).alias("path"))
    return readers.base_page(paths)


@query("SELECT 'plans/' || source || '/' || doc_id AS folder, count(*) AS n FROM (SELECT source, doc_id FROM documents WHERE lang <> 'es' UNION ALL SELECT source, doc_id FROM documents WHERE lang = 'de') GROUP BY 1")
def split_list_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists are read one after the other; blanks go, repeats stay."""
    d = D.read(spark, sf_dir, "documents")
    line = F.concat(F.lit("/plans/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(" "))
    first = d.select(F.when(F.col("lang") == "es", "  ").otherwise(line).alias("value"))
    lists = first.unionByName(d.where("lang = 'de'").select(line.alias("value")))
    return readers.split_list(lists).groupBy("folder").agg(F.count(F.lit(1)).alias("n"))


# Pages ----------------------------------------------------------------------------------------------------------

_ANSWER = "CASE p_partkey % 4 WHEN 0 THEN 'Yes' WHEN 1 THEN 'no' WHEN 2 THEN ' YES, it is' ELSE 'maybe' END"


@query(f"SELECT p_name || '-' || p_partkey AS file, p_partkey % 4 IN (0, 2) AS kept, CASE WHEN p_partkey % 4 IN (1, 3) THEN 'no floor plan' END AS reason, CASE WHEN p_partkey % 4 IN (0, 2) THEN true END AS cropped, CASE WHEN p_partkey % 4 IN (0, 2) THEN './' || p_name || '-' || p_partkey END AS out FROM (SELECT *, {_ANSWER} AS answer FROM part)")
def vlm_yesno_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.decision_log(D.read(spark, sf_dir, "part").select(F.expr("p_name || '-' || p_partkey").alias("file"), F.expr(_ANSWER).alias("answer")), "file", "answer")


_BOX_TEXT = """CASE image_id % 5 WHEN 0 THEN 'The box is [' || w // 4 || ', ' || h // 4 || ', ' || w // 2 || ', ' || h // 2 || '].' WHEN 1 THEN '[900, 10, 20, 30]'
  WHEN 2 THEN '[0, 0, ' || w || ',' || h || ']' WHEN 3 THEN '[ 5,6 , 99999, 60] or [1,2,3,4]' ELSE 'none [-1, 2, 3, 4]' END"""


@query(with_inputs("v", """SELECT image_id, CAST(CASE image_id % 5 WHEN 0 THEN w // 4 WHEN 3 THEN 5 END AS INTEGER) AS x1, CAST(CASE image_id % 5 WHEN 0 THEN h // 4 WHEN 3 THEN 6 END AS INTEGER) AS y1,
  CAST(CASE image_id % 5 WHEN 0 THEN w // 2 WHEN 3 THEN w END AS INTEGER) AS x2, CAST(CASE image_id % 5 WHEN 0 THEN h // 2 WHEN 3 THEN least(h, 60) END AS INTEGER) AS y2 FROM v"""))
def vlm_bbox_parse_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.images(spark, sf_dir).withColumn("text", F.expr(_BOX_TEXT.replace("//", "div")))
    return rows.select("image_id", pages.answered_box(F.col("text"), F.col("w"), F.col("h")).alias("b")).select("image_id", "b.x1", "b.y1", "b.x2", "b.y2")


@query(with_inputs("v", """, s AS (SELECT *, least(1024.0::DOUBLE / w, 1024.0::DOUBLE / h, 1.0::DOUBLE) AS s FROM v), n AS (SELECT *, CAST(trunc(w * s) AS INTEGER) AS nw, CAST(trunc(h * s) AS INTEGER) AS nh FROM s)
SELECT image_id, nw, nh, greatest(0, CAST(trunc(10 * (w / CAST(nw AS DOUBLE))) AS INTEGER) - 20) AS x1, greatest(0, CAST(trunc(50 * (h / CAST(nh AS DOUBLE))) AS INTEGER) - 20) AS y1,
  least(w, CAST(trunc((nw - 30) * (w / CAST(nw AS DOUBLE))) AS INTEGER) + 20) AS x2, least(h, CAST(trunc((nh - 3) * (h / CAST(nh AS DOUBLE))) AS INTEGER) + 20) AS y2 FROM n"""))
def vlm_resize_scale_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.images(spark, sf_dir).withColumn("s", pages.shown_size(F.col("w"), F.col("h")))
    box = F.struct(F.lit(10).alias("x1"), F.lit(50).alias("y1"), (F.col("s.nw") - 30).alias("x2"), (F.col("s.nh") - 3).alias("y2"))
    back = pages.page_box(box, F.col("s.by_x"), F.col("s.by_y"), F.col("w"), F.col("h"))
    return rows.select("image_id", "s.nw", "s.nh", back.alias("b")).select("image_id", "nw", "nh", "b.x1", "b.y1", "b.x2", "b.y2")


# Pixels ---------------------------------------------------------------------------------------------------------


@query(with_inputs("px", """, g AS (SELECT image_id, y, x, CAST((v * 1868 + (255 - v) * 9617 + (v * 7 % 256) * 4899 + 8192) >> 14 AS INTEGER) AS v FROM px),
n AS (SELECT image_id, y, x, v AS gray, CAST(CASE WHEN hi > lo THEN round_even(CAST(CAST(v AS FLOAT) * CAST(255.0::DOUBLE / (hi - lo) AS FLOAT) + CAST(-lo * (255.0::DOUBLE / (hi - lo)) AS FLOAT) AS DOUBLE), 0) ELSE 0 END AS INTEGER) AS v FROM (SELECT *, min(v) OVER (PARTITION BY image_id) AS lo, max(v) OVER (PARTITION BY image_id) AS hi FROM g))
SELECT image_id, y, x, gray, v AS norm, v > 127 AS above FROM n"""))
def gray_threshold_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("v")
    g = pixels.gray(D.pixels(spark, sf_dir).select(*pixels.KEY, v.alias("b"), (255 - v).alias("g"), (v * 7 % 256).alias("r")))
    n = pixels.min_max(g.withColumn("gray", F.col("v")))
    return n.select("image_id", "y", "x", "gray", F.col("v").alias("norm"), (F.col("v") > 127).alias("above"))


_PX_TILES = "tl AS (SELECT image_id, y, x, v, CAST(ty AS INTEGER) AS ty, CAST(tx AS INTEGER) AS tx FROM px, unnest(range(0, 8, 3)) AS r(ty), unnest(range(0, 8, 3)) AS c(tx) WHERE y BETWEEN ty AND ty + 3 AND x BETWEEN tx AND tx + 3)"


@query(with_inputs("px", ", " + _PX_TILES + " SELECT * FROM (SELECT image_id, ty, tx, (sum(CASE WHEN v > 150 THEN 1 ELSE 0 END) + 16 - count(*)) / 16.0::DOUBLE AS blank_share FROM tl GROUP BY ALL) WHERE blank_share <= 0.5"))
def blank_tile_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles that are not nearly blank."""
    tiles = pixels.tiles(D.pixels(spark, sf_dir), D.image_sizes(spark, sf_dir), TILE, STRIDE)
    return pixels.blank_share(tiles, ["image_id", "ty", "tx"], TILE * TILE, 150).where("blank_share <= 0.5")


@query(with_inputs("e px", """, ink AS (SELECT * FROM px WHERE v <= 40), r AS (SELECT image_id, min(y) AS y1, max(y) AS y2 FROM (SELECT image_id, y FROM ink GROUP BY ALL HAVING count(*) > 0.08) GROUP BY 1),
q AS (SELECT image_id, min(x) AS x1, max(x) AS x2 FROM (SELECT image_id, x FROM ink GROUP BY ALL HAVING count(*) > 0.08) GROUP BY 1)
SELECT image_id, CAST(coalesce(greatest(0, y1 - 1), 0) AS INTEGER) AS y1, CAST(coalesce(least(8, y2 + 1), 8) AS INTEGER) AS y2, CAST(coalesce(greatest(0, x1 - 1), 0) AS INTEGER) AS x1, CAST(coalesce(least(8, x2 + 1), 8) AS INTEGER) AS x2
FROM (SELECT image_id FROM e WHERE hi > lo) LEFT JOIN r USING (image_id) LEFT JOIN q USING (image_id)"""))
def auto_crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pixels.ink_box(D.pixels(spark, sf_dir), D.image_sizes(spark, sf_dir), 40, 1)


@query(with_inputs("px", ", " + _PX_TILES + """ SELECT image_id, y, x, CAST(sum(hit) AS BIGINT) AS s, count(*) AS n FROM (SELECT *, CASE WHEN v > 127 AND (ty + tx) % 2 = 0 THEN 1 ELSE 0 END AS hit FROM tl) GROUP BY ALL HAVING 10 * sum(hit) > 3 * count(*)"""))
def stitch_mean_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masks of overlapping tiles, half of which find nothing, put together."""
    sizes = D.image_sizes(spark, sf_dir)
    tiles = pixels.tiles(D.pixels(spark, sf_dir), sizes, TILE, STRIDE)
    hit = ((F.col("v") > 127) & ((F.col("ty") + F.col("tx")) % 2 == 0)).cast("int")
    masks = tiles.select("image_id", "ty", "tx", (F.col("y") - F.col("ty")).alias("py"), (F.col("x") - F.col("tx")).alias("px"), hit.alias("hit"))
    return pixels.stitched(masks, sizes)


@query(with_inputs("px", """SELECT image_id, CAST(sum(CASE WHEN v > 100 OR v < 60 THEN 1 ELSE 0 END) AS BIGINT) AS n_union, CAST(sum(CASE WHEN v > 100 AND v < 160 THEN 1 ELSE 0 END) AS BIGINT) AS n_both, CAST(sum(CASE WHEN v > 160 THEN 1 ELSE 0 END) AS BIGINT) AS n_left FROM px GROUP BY image_id"""))
def mask_set_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = D.pixels(spark, sf_dir)
    bright, dark, middle, light = pixels.mask(px, 100), px.where("v < 60"), px.where("v < 160"), px.where("v <= 160")
    parts = {"n_union": pixels.union(bright, dark), "n_both": pixels.intersection(bright, middle), "n_left": pixels.difference(bright, light)}
    out = px.select("image_id").distinct()
    for name, part in parts.items():
        out = out.join(part.groupBy("image_id").agg(F.count(F.lit(1)).alias(name)), "image_id", "left")
    return out.fillna(0, list(parts))


@query(with_inputs("px", "SELECT DISTINCT p.image_id, p.y, p.x FROM px p JOIN px q ON p.image_id = q.image_id AND abs(p.y - q.y) <= 1 AND abs(p.x - q.x) <= 1 WHERE q.v > 180"))
def dilate_square(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.dilated(D.gray_images(spark, sf_dir), 180, 1)


def _parts(names: str, above: str) -> str:
    """Recursive SQL: for set pixels, the least place that neighbours lead to."""
    return f"""s AS (SELECT image_id, y, x, y * 8 + x AS k FROM px WHERE {above}),
  reach AS (SELECT image_id, y, x, k FROM s UNION SELECT r.image_id, t.y, t.x, r.k FROM reach r JOIN s t ON r.image_id = t.image_id AND abs(r.y - t.y) <= 1 AND abs(r.x - t.x) <= 1),
  {names} AS (SELECT image_id, y, x, min(k) AS root FROM reach GROUP BY ALL)"""


@query(with_inputs("px", ", " + _parts("part", "v > 150") + """, lab AS (SELECT *, dense_rank() OVER (PARTITION BY image_id ORDER BY root) AS label FROM part), cnt AS (SELECT image_id, label, count(*) AS n FROM lab GROUP BY ALL),
big AS (SELECT image_id, label FROM cnt QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY n DESC, label) = 1)
SELECT l.image_id, y, x, CAST(l.label AS INTEGER) AS label, l.label = b.label AS largest FROM lab l JOIN big b USING (image_id)"""))
def connected_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.component_labels(D.gray_images(spark, sf_dir), 150)


_RING = """z AS (SELECT image_id, y, x FROM (SELECT m.*, CAST(trunc(least(y2 - y1, x2 - x1) * {1}::DOUBLE) AS INTEGER) AS wide FROM
  (SELECT image_id, y, x, min(y) OVER w AS y1, max(y) OVER w AS y2, min(x) OVER w AS x1, max(x) OVER w AS x2 FROM px WHERE {0} WINDOW w AS (PARTITION BY image_id)) m)
  WHERE y < y2 AND x < x2 AND NOT (y >= y1 + wide AND y < y2 - wide AND x >= x1 + wide AND x < x2 - wide))"""


@query(with_inputs("px", ", " + _RING.format("v > 127", 0.2) + " SELECT * FROM z"))
def bbox_border_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pixels.border_zone(pixels.mask(D.pixels(spark, sf_dir), 127), 0.2)


@query(with_inputs("px", ", " + _RING.format("v > 127", 0.2) + " SELECT * FROM z"))
def border_ring_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.border_rings(D.gray_images(spark, sf_dir), 127, 0.2)


@query(with_inputs("px", ", " + _RING.format("v > 127", 0.05) + " SELECT i.image_id, count(z.y) AS n FROM (SELECT DISTINCT image_id FROM px) i LEFT JOIN z USING (image_id) GROUP BY 1"))
def border_zone_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ring pixels at the default share, where small masks have no ring."""
    px = D.pixels(spark, sf_dir)
    zone = pixels.border_zone(pixels.mask(px, 127), 0.05).groupBy("image_id").agg(F.count(F.lit(1)).alias("n"))
    return px.select("image_id").distinct().join(zone, "image_id", "left").fillna(0, ["n"])


@query(with_inputs("px", ", " + _parts("part", "v > 150") + ", " + _RING.format("v <= 100", 0.2) + """, big AS (SELECT image_id, root FROM part GROUP BY image_id, root QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY count(*) DESC, root) = 1),
near AS (SELECT DISTINCT m.image_id, m.y, m.x FROM px m JOIN part p ON m.image_id = p.image_id AND abs(m.y - p.y) <= 1 AND abs(m.x - p.x) <= 1 JOIN big b ON b.image_id = p.image_id AND b.root = p.root WHERE m.v <= 100),
o AS (SELECT image_id, y, x FROM near UNION SELECT image_id, y, x FROM z)
SELECT i.image_id, count(o.y) AS outer_pixels, count(m.y) - count(o.y) AS inner_pixels FROM (SELECT DISTINCT image_id FROM px) i LEFT JOIN (SELECT * FROM px WHERE v <= 100) m ON m.image_id = i.image_id LEFT JOIN o ON o.image_id = m.image_id AND o.y = m.y AND o.x = m.x GROUP BY i.image_id"""))
def classify_outer_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.outer_inner(D.gray_images(spark, sf_dir), 100, 150, 1, 0.2)


_OTSU = """, hist AS (SELECT image_id, v, count(*) AS n FROM px GROUP BY ALL), cum AS (SELECT image_id, v, sum(n) OVER o AS n0, sum(n * v) OVER o AS s0, sum(n) OVER a AS n, sum(n * v) OVER a AS s FROM hist
  WINDOW o AS (PARTITION BY image_id ORDER BY v), a AS (PARTITION BY image_id))
SELECT image_id, v AS threshold FROM cum QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY CASE WHEN n0 < n THEN pow(CAST(s0 * n - s * n0 AS DOUBLE), 2) / CAST(n0 * (n - n0) AS DOUBLE) ELSE 0 END DESC, v) = 1"""


@query(with_inputs("px", _OTSU))
def otsu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.otsu(D.gray_images(spark, sf_dir))


@query(with_inputs("px", _OTSU))
def otsu_pixel_relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pixels.otsu(D.pixels(spark, sf_dir))


def _window(y: str, x: str) -> str:
    """SQL: 16 times the 3 x 3 Gaussian mean, where neighbours beyond the edge lie at the given places."""
    return f"""w AS (SELECT p.image_id, p.y, p.x, p.v, sum(q.v * (2 - abs(dy)) * (2 - abs(dx))) AS s FROM px p, (VALUES (-1), (0), (1)) AS a(dy), (VALUES (-1), (0), (1)) AS b(dx), px q
  WHERE q.image_id = p.image_id AND q.y = {y} AND q.x = {x} GROUP BY ALL)"""


_REPEAT = ("greatest(0, least(7, p.y + dy))", "greatest(0, least(7, p.x + dx))")
_MIRROR = tuple(f"CASE WHEN {e} < 0 THEN 1 WHEN {e} > 7 THEN 6 ELSE {e} END" for e in ("p.y + dy", "p.x + dx"))


@query(with_inputs("px", ", " + _window(*_REPEAT) + " SELECT image_id, y, x, CAST(CASE WHEN v > floor(s / 16.0::DOUBLE + 0.5) - 5 THEN 255 ELSE 0 END AS INTEGER) AS v FROM w"))
def adaptive_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.adaptive(D.gray_images(spark, sf_dir), 3, 5)


@query(with_inputs("px", ", " + _window(*_MIRROR) + " SELECT image_id, y, x, CAST(floor(s / 16.0::DOUBLE + 0.5) AS INTEGER) AS v FROM w"))
def gaussian_blur(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.blurred(D.gray_images(spark, sf_dir), 3)


_NORM = """n AS (SELECT image_id, y, x, CAST(CASE WHEN hi > lo THEN round_even(CAST(CAST(v AS FLOAT) * CAST(255.0::DOUBLE / (hi - lo) AS FLOAT) + CAST(-lo * (255.0::DOUBLE / (hi - lo)) AS FLOAT) AS DOUBLE), 0) ELSE 0 END AS INTEGER) AS v
  FROM (SELECT *, min(v) OVER (PARTITION BY image_id) AS lo, max(v) OVER (PARTITION BY image_id) AS hi FROM px))"""


def _mean(name: str, source: str, size: int, places: tuple[str, str]) -> str:
    """SQL: ``v`` and the Gaussian mean ``g`` of a window of 3 or 5, in whole numbers."""
    reach, weights = size // 2, {3: "2 - abs({0})", 5: "CASE abs({0}) WHEN 0 THEN 6 WHEN 1 THEN 4 ELSE 1 END"}[size]
    steps = ", ".join(f"({d})" for d in range(-reach, reach + 1))
    return f"""{name} AS (SELECT p.image_id, p.y, p.x, p.v, CAST(floor(sum(q.v * ({weights.format("dy")}) * ({weights.format("dx")})) / {4.0 ** (size - 1)}::DOUBLE + 0.5) AS INTEGER) AS g
  FROM {source} p, (VALUES {steps}) AS a(dy), (VALUES {steps}) AS b(dx), {source} q WHERE q.image_id = p.image_id AND q.y = {places[0]} AND q.x = {places[1]} GROUP BY ALL)"""


@query(with_inputs("px", ", " + _NORM + ", " + _mean("m", "n", 3, _MIRROR) + ", k AS (SELECT image_id, y, x, g AS v FROM m), " + _mean("t", "k", 5, _REPEAT) + " SELECT image_id, y, x, CAST(CASE WHEN v > g - 5 THEN 255 ELSE 0 END AS INTEGER) AS v FROM t"))
def preprocess_bin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.preprocessed(D.gray_images(spark, sf_dir), "bin", 3, 5, 5)


@query()
def mask_to_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.polygons(D.gray_images(spark, sf_dir), 1.0, 0.002)


@query(with_inputs("px", ", " + _mean("m", "px", 3, _MIRROR) + ", k AS (SELECT image_id, y, x, g AS v FROM m), " + _mean("t", "k", 3, _REPEAT) + """ SELECT image_id, y, x, CAST(CASE
  WHEN (y BETWEEN 2 AND 5 AND x IN (1, 6)) OR (x BETWEEN 2 AND 5 AND y IN (1, 6)) THEN 255 WHEN y BETWEEN 3 AND 4 AND x BETWEEN 3 AND 4 THEN 255
  WHEN y BETWEEN 2 AND 5 AND x BETWEEN 2 AND 5 THEN 0 WHEN v > g - 5 THEN 255 ELSE 0 END AS INTEGER) AS v FROM t"""))
def label_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = np.array([[2, 2], [5, 2], [5, 5], [2, 5]])
    return U.styled(D.gray_images(spark, sf_dir), lambda a: [box], edge=1, ring=1, block=3, c=5)


@query(with_inputs("px", ", " + _PX_TILES + " SELECT image_id, y, x, count(*) AS s, count(*) AS n FROM tl WHERE v < 128 GROUP BY ALL"))
def predict_and_stitch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles through the stand-in model, stitched to the set pixels of pages."""
    sizes = D.image_sizes(spark, sf_dir)
    tiles = U.tiles(D.gray_images(spark, sf_dir), TILE, STRIDE)
    masks = models.tile_masks(tiles, models.stand_in)
    hits = masks.select("image_id", "ty", "tx", F.posexplode(F.split(F.rtrim(F.regexp_replace(F.hex("hits"), "(..)", "$1 ")), " ")).alias("p", "b"))
    rows = hits.select(
        "image_id", "ty", "tx", F.floor(F.col("p") / TILE).cast("int").alias("py"), (F.col("p") % TILE).alias("px"), (F.col("b") == "01").cast("int").alias("hit")
    )
    return pixels.stitched(rows, sizes)


@query(with_inputs("px", "SELECT image_id, count(*) FILTER (v < 128) AS n_set, 8 AS h, 8 AS w FROM px GROUP BY image_id"))
def page_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, a page's mask as one row of bytes."""
    tiles = U.tiles(D.gray_images(spark, sf_dir), TILE, STRIDE)
    pages_ = models.page_masks(models.tile_masks(tiles, models.stand_in), D.image_sizes(spark, sf_dir))
    ones = F.length(F.regexp_replace(F.hex("mask"), "00", "")) / 2
    return pages_.select("image_id", ones.cast("long").alias("n_set"), "h", "w")


@query(with_inputs("u", """, s AS (SELECT CASE WHEN category_id = 1 THEN 'rect' ELSE 'slab' END AS kind, image_id, ann_id, angle FROM u, (VALUES (0), (90)) AS g(angle)),
n AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY image_id, angle, ann_id) AS idx FROM s)
SELECT printf('%s_floor%d_id%d_rot%d_i%04d', kind, image_id, ann_id, angle, idx) AS name, kind, CAST(idx AS BIGINT) AS idx FROM n WHERE kind = 'rect' OR idx <= 300"""))
def dataset_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of a dataset's samples, of which one kind is capped."""
    return datasets.numbered_samples(_objects(spark, sf_dir), [0, 90], max_slabs=300).select("name", "kind", "idx")


def _objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.skewed(D.unique_annotations(spark, sf_dir))
    named = rows.select(F.col("image_id").alias("floor_id"), F.col("ann_id").alias("object_id"), "polygon", "category_id")
    return datasets.objects(named.where("category_id = 1").drop("category_id"), named.where("category_id <> 1").drop("category_id"))


@query(with_inputs("u", "SELECT count(*) FILTER (category_id = 1) AS rects, count(*) FILTER (category_id <> 1) AS slabs FROM u"))
def object_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.object_totals(N.included(_objects(spark, sf_dir)))


@query(with_inputs("u", "SELECT count(*) FILTER (category_id = 1) AS rects, 0::BIGINT AS slabs, count(*) FILTER (category_id = 1 AND ann_id % 5 <> 0) AS saved, count(*) FILTER (category_id = 1 AND ann_id % 5 = 0) AS skipped FROM u WHERE image_id <= 200"))
def dataset_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of some floors (a parameter of the build), of which those without a polygon are skipped with an error."""
    some = N.included(_objects(spark, sf_dir), slabs=False).where("floor_id <= 200")
    broken = some.withColumn("polygon", F.when(F.col("object_id") % 5 != 0, F.col("polygon")))
    return datasets.sample_counts(datasets.samples(datasets.numbered_samples(broken, [0]), size=64))


@query("SELECT 'cc5k_a_' || p_partkey || printf('_r%04d_c%04d', p_size, p_size * 2) AS plan, 'p' || p_partkey || printf('_rot%d_r%04d_c%04d', 90, p_size, p_size * 2) AS turned FROM part")
def tile_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names of tiles of plans and of turned pages."""
    k = F.col("p_partkey").cast("string")
    rows = D.read(spark, sf_dir, "part").withColumn("ty", F.col("p_size")).withColumn("tx", F.col("p_size") * 2)
    return rows.select(
        tiling.plan_tile_name(F.concat(F.lit("a/"), k)).alias("plan"), tiling.turned_tile_name(F.concat(F.lit("p"), k), F.lit(90)).alias("turned")
    )


@query(f"SELECT count(*) FILTER (p_partkey % 4 IN (0, 2)) AS kept, count(*) FILTER (p_partkey % 4 IN (1, 3)) AS skipped FROM part")
def decision_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.decision_counts(vlm_yesno_filter(spark, sf_dir))


@query(with_inputs("px", """SELECT count(DISTINCT image_id) FILTER (image_id % 3 = 0) AS processed, count(DISTINCT image_id) FILTER (image_id % 3 = 1) AS skipped, count(DISTINCT image_id) FILTER (image_id % 3 = 2) AS failed FROM px"""))
def style_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of styling images by label lines: a box, none, or a line that is too short."""
    images = D.gray_images(spark, sf_dir)
    line = F.when(F.col("image_id") % 3 == 0, "0 .25 .25 .75 .25 .75 .75 .25 .75").when(F.col("image_id") % 3 == 2, "0 1 2")
    lines = images.select("image_id", F.coalesce(line, F.lit(" ")).alias("line"))
    return U.outcome_counts(U.styled_by_labels(images, lines, ring=1, block=3))


@query(with_inputs("v", "SELECT count(*) FILTER (image_id % 4 = 1) AS no_xml, count(*) FILTER (image_id % 4 = 2) AS bad_point, count(*) FILTER (image_id % 4 = 3) AS missing FROM v"))
def svg_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drawings that have no walls for a fault."""
    text = F.element_at(F.array(F.lit('<svg><g id="Wall"><polygon points="0,0 9,0 9,9"/></g></svg>'), F.lit("<svg><g>"),
                                F.lit('<svg><g id="Wall"><polygon points="0,0 a,0 9,9"/></g></svg>'), F.lit(None)), (F.col("image_id") % 4 + 1).cast("int"))
    errors = readers.svg_errors(D.images(spark, sf_dir).select("image_id", text.alias("svg")))
    return errors.agg(
        F.count_if(F.startswith("error", F.lit("no XML"))).alias("no_xml"),
        F.count_if(F.startswith("error", F.lit("a point"))).alias("bad_point"),
        F.count_if(F.startswith("error", F.lit("no drawing"))).alias("missing"),
    )


@query("SELECT count(*) AS n FROM part WHERE CAST(('0x' || substr(md5('13:' || p_partkey), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE < 0.25")
def training_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbering.fraction(D.read(spark, sf_dir, "part"), "p_partkey", 0.25).agg(F.count(F.lit(1)).alias("n"))
