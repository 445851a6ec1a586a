"""Every registered query of the engine against its SQL, and files read and written."""

import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright.operators import annotations, datasets, kernel_udfs, kernels, models, numbering, pages, tiling
from tilewright.plans import adapters, catalogue
from tilewright.sources import readers, writers

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_sql(spark, duck, name):
    out = catalogue.QUERIES[name](spark, SF)
    columns = sorted(out.columns)
    got = sorted(str([r[c] for c in columns]) for r in out.collect())
    assert got
    if name in catalogue.ORACLES:
        rel = duck.sql(catalogue.ORACLES[name])
        assert sorted(rel.columns) == columns
        places = [rel.columns.index(c) for c in columns]
        assert got == sorted(str([r[i] for i in places]) for r in rel.fetchall())


def test_filters_reach_the_scan(spark):
    plan = catalogue.walls_only(spark, SF)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int>" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_images_round_trip(spark, tmp_path):
    rng = np.random.default_rng(2)
    color, gray = rng.integers(0, 256, (7, 5, 3), dtype=np.uint8), rng.integers(0, 256, (4, 6), dtype=np.uint8)
    rows = [("a", 7, 5, color.tobytes()), ("b", 4, 6, gray.tobytes())]
    writers.write_pngs(spark.createDataFrame(rows, "name string, h int, w int, data binary"), str(tmp_path))
    (tmp_path / "broken.png").write_bytes(b"no image")
    (tmp_path / "note.txt").write_text("x")
    got = {os.path.basename(r["path"]): r for r in readers.read_images(spark, str(tmp_path), (".PNG",)).collect()}
    assert set(got) == {"a.png", "b.png"}
    assert bytes(got["a.png"]["data"]) == color.tobytes() and bytes(got["b.png"]["data"]) == gray.tobytes()


def test_files_of_annotations(spark, tmp_path):
    (tmp_path / "c.json").write_text(
        '{"categories":[{"id":0,"name":"o"},{"id":5,"name":"Walls"}],\n"images":[{"id":1,"file_name":"x.png"}],'
        '"annotations":[{"image_id":1,"category_id":5,"segmentation":[[0,1,2,3,4,5,6],[7,8]]}]}'
    )
    cats, images, shapes = readers.read_coco(spark, str(tmp_path / "c.json"))
    assert images.count() == 1 and [(r["ring"], len(r["polygon"])) for r in shapes.orderBy("ring").collect()] == [(0, 3), (1, 1)]
    classes = annotations.class_map(cats)
    assert writers.descriptor(classes).endswith("nc: 1\nnames:\n  0: Walls\n")
    (tmp_path / "f.json").write_text('{"floors":[{"id":3,"rects":[{"id":1,"points":[{"x":0,"y":1}]}],"slabs":[]}]}')
    rects, slabs = readers.read_floors(spark, str(tmp_path / "f.json"))
    assert [r["floor_id"] for r in rects.collect()] == [3] and slabs.count() == 0
    (tmp_path / "l.txt").write_text("0 .1 .2 .3 .4 .5 .6\n\n1 2\n")
    assert [r["name"] for r in readers.read_labels(spark, str(tmp_path)).where("line <> ''").collect()] == ["l", "l"]
    (tmp_path / "m.svg").write_text('<svg><g id="Railing"><polygon points="0,0 9,0 9,9 x"/></g><g id="Wall"><polygon points="0,0 3,9 3,1"/></g></svg>')
    assert [len(r["polygon"]) for r in readers.read_svg(spark, str(tmp_path)).collect()] == [3]


def test_samples_are_written_by_split(spark, tmp_path):
    rows = numbering.bernoulli_split(spark.range(50), "id").withColumn("label", F.lit("x"))
    writers.write_samples(rows, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).groupBy("split").count().count() == 2


def test_tiles_of_ones_stitch_to_ones(spark):
    image = spark.createDataFrame([(1, 9, 11, bytes([0] * 99))], kernel_udfs.IMAGE)
    masks = models.tile_masks(kernel_udfs.tiles(image, 4, 3), models.stand_in).collect()
    total, n = np.zeros((20, 20)), np.zeros((20, 20))
    for r in masks:
        total[r["ty"] : r["ty"] + 4, r["tx"] : r["tx"] + 4] += np.frombuffer(r["hits"], dtype=np.uint8).reshape(4, 4)
        n[r["ty"] : r["ty"] + 4, r["tx"] : r["tx"] + 4] += 1
    assert (total[:9, :11] == n[:9, :11]).all() and total.sum() == n[:9, :11].sum()


def test_parameters_are_checked(spark):
    with pytest.raises(ValueError):
        tiling.tile_grid(adapters.images(spark, SF), 512, 512)
    with pytest.raises(ValueError):
        annotations.times_rotations(spark.range(1), [45])
    assert annotations.parse_int_list(" ,") == [0] and annotations.parse_int_list("90, 180") == [90, 180]
    assert tiling.tile_grid(spark.createDataFrame([(1, 0, 5)], "image_id long, w int, h int")).count() == 0


def test_grid_of_tiles_is_not_broadcast(spark):
    pages, shapes = adapters.images(spark, SF), adapters.boxes(adapters.annotations(spark, SF))
    joined = tiling.tiles_by_join(pages, shapes)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    columns = ["image_id", "ann_id", "ty", "tx"]
    want = tiling.tiles_by_explode(pages.join(shapes, "image_id")).select(*columns)
    assert sorted(joined.select(*columns).collect()) == sorted(want.collect())
    assert joined.columns == [*tiling.tile_grid(pages).columns, *[c for c in shapes.columns if c != "image_id"]]


def test_polygons_agree_with_their_mask(spark):
    for r in kernel_udfs.polygons(adapters.gray_images(spark, SF), 1.0, 0.0).take(50):
        p = np.array(r["coords"]).reshape(-1, 2).astype(int)
        assert len(p) >= 3 and kernels.contour_area(p) >= 1


def test_bad_rows_end_no_job(spark):
    """What one row holds never ends a scan: it has no result, or says why."""
    svg = '<svg><g id="Wall"><polygon points="{}"/></g></svg>'
    rows = [(1, svg.format("0,0 9,0 9,9")), (2, "<svg><g>"), (3, svg.format("0,0 a,b 9,9 1,1")), (4, None), (5, ""), (6, svg.format("0,0 9,0 1,2,3 9,9"))]
    drawings = spark.createDataFrame(rows, "id long, svg string")
    assert sorted(r["id"] for r in readers.svg_walls(drawings).collect()) == [1, 6]
    errors = {r["id"]: r["error"] for r in readers.svg_errors(drawings).collect()}
    assert set(errors) == {2, 3, 4, 5} and errors[3] == "a point is not two numbers" and errors[4] == "no drawing"
    lines = ["0 .1 .2 .3 .4 .5 .6", "0 .1 x .3 .4 .5 .6", "q .1 .2 .3 .4 .5 .6", "99999999999 .1 .2 .3 .4 .5 .6", "0 nan .2 .3 .4 .5 .6", None, ""]
    table = spark.createDataFrame([(x, 10, 10) for x in lines], "line string, w int, h int")
    for strict in (True, False):
        assert [r["class_id"] for r in readers.label_polygons(table, strict=strict).collect()] == [0]
    answers = spark.createDataFrame([("[1, 2, 99999999999, 40]", 50, 60), ("[1,2," + "9" * 60 + ",4]", 50, 60), (None, 50, 60)], "t string, w int, h int")
    boxes = [r["b"] for r in answers.select(pages.answered_box(F.col("t"), F.col("w"), F.col("h")).alias("b")).collect()]
    assert [tuple(b) if b else None for b in boxes] == [(1, 2, 50, 40), None, None]
    thin = spark.createDataFrame([(20000, 5), (0, 0)], "w int, h int").select(pages.shown_size(F.col("w"), F.col("h")).alias("s")).collect()
    assert [(r["s"]["nw"], r["s"]["by_y"]) for r in thin][0] == (1024, None)
    names = spark.createDataFrame([("a_tile_r0001_c0002.png",), ("a_tile_r99999999999_c0.png",)], "path string")
    assert [(r["ty"], r["tx"]) for r in readers.tile_places(names).collect()] == [(1, 2)]


def test_null_keys_are_numbered(spark):
    rows = spark.createDataFrame([(None, 1), (5, 2), (70000, 3)], "id long, n int")
    assert sorted(r["worker"] for r in numbering.round_robin(rows, "id", 3).collect()) == [0, 1, 2]
    assert numbering.prefix_split(rows, "id").count() == 3
    assert numbering.running_cutoff(rows, "id", "n", 3).count() == 2
    grouped = numbering.by_id(rows.withColumn("g", F.lit(None).cast("string")), "id", of=["g"])
    assert sorted(r["idx"] for r in grouped.collect()) == [0, 1, 2]


def test_single_category_is_the_first_of_its_name(spark):
    table = spark.createDataFrame([(7, "Walls"), (3, "Walls"), (1, "door")], "id int, name string")
    assert [tuple(r) for r in annotations.class_map(table, "Walls").collect()] == [(3, "Walls", 0)]
    with pytest.raises(ValueError):
        annotations.class_map(table, "roof")


def test_samples_carry_their_errors(spark):
    points = "array<struct<x:double,y:double>>"
    square = [(0.0, 0.0), (40.0, 0.0), (40.0, 20.0), (0.0, 20.0)]
    rects = spark.createDataFrame([(1, 1, square), (1, 2, None), (2, 3, [(1.0, 1.0)]), (2, 4, [(float("nan"), 0.0)] * 3)], f"floor_id long, object_id long, polygon {points}")
    slabs = rects.where("object_id = 1")
    rows = datasets.numbered_samples(datasets.objects(rects, slabs), [0, 90])
    made = datasets.samples(rows, 64, 4.0)
    got = made.collect()
    assert len(got) == 10 and tuple(datasets.sample_counts(made).first()) == (8, 2, 4, 6)
    for r in got:
        assert (r["error"] is None) == (r["object_id"] == 1) == (r["data"] is not None)
        if r["error"] is None:
            image = np.frombuffer(r["data"], dtype=np.uint8).reshape(64, 64)
            assert r["label"].startswith(f"{int(r['kind'] == 'slab')} ") and len(r["label"].split()) >= 9
            ys, xs = np.nonzero(image == 0)
            wide, high = np.ptp(xs), np.ptp(ys)
            assert (wide > high) == (r["angle"] == 0)
    assert {r["name"] for r in got if r["object_id"] == 1} >= {"rect_floor1_id1_rot0_i0001", "slab_floor1_id1_rot90_i0002"}
    assert datasets.numbered_samples(datasets.objects(rects, slabs), [0], max_rects=2).where("kind = 'rect'").count() == 2


def test_inference_from_tiles_and_images(spark):
    page = np.full((9, 11), 255, dtype=np.uint8)
    page[2:7, 2:9] = 0
    images = spark.createDataFrame([(1, 9, 11, page.tobytes()), (2, 9, 11, None)], kernel_udfs.IMAGE)
    tiles = models.tile_masks(kernel_udfs.tiles(images, 4, 3), models.stand_in)
    stitched = models.page_masks(tiles, images)
    single = models.image_masks(images, models.stand_in)
    for masks in (stitched, single):
        r = masks.first()
        assert (np.frombuffer(r["mask"], dtype=np.uint8).reshape(9, 11) == (page == 0)).all() and r["n_instances"] >= 1
    for trace in (True, False):
        out = models.overlays(images, single, trace, 5.0).first()
        shown = np.frombuffer(out["data"], dtype=np.uint8).reshape(9, 11, 3)
        assert (shown[2, 4] == (kernels.RED if trace else [0, 80, 255])).all() and out["n_instances"] == 1


def test_labels_style_and_draw_images(spark):
    images = spark.createDataFrame([(i, 12, 12, bytes([90] * 144)) for i in range(3)], kernel_udfs.IMAGE)
    square = "0 .25 .25 .75 .25 .75 .75 .25 .75"
    lines = spark.createDataFrame([(0, square), (0, "1 2"), (1, "1 2 3")], "image_id long, line string")
    styled = kernel_udfs.styled_by_labels(images, lines, ring=1, block=3)
    assert {r["image_id"]: r["outcome"] for r in styled.collect()} == {0: "processed", 1: "failed", 2: "skipped"}
    assert tuple(kernel_udfs.outcome_counts(styled).first()) == (1, 1, 1)
    assert tuple(kernel_udfs.outcome_counts(styled.limit(0)).first()) == (0, 0, 0)
    want = kernels.label_styled(np.full((12, 12), 90, dtype=np.uint8), [np.array([[3, 3], [9, 3], [9, 9], [3, 9]])], 1, 1, 3, 5)
    assert bytes(styled.where("image_id = 0").first()["data"]) == want.tobytes()
    drawn = kernel_udfs.drawn(images, lines).collect()
    assert [r["image_id"] for r in drawn] == [0] and len(drawn[0]["data"]) == 3 * 144


def test_pages_are_cut_to_their_answer(spark):
    page = np.arange(60 * 80, dtype=np.uint32).astype(np.uint8)
    rows = [(1, 60, 80, page.tobytes(), "[30, 30, 40, 40]"), (2, 60, 80, page.tobytes(), "no box")]
    table = spark.createDataFrame(rows, kernel_udfs.IMAGE + ", bbox_text string")
    got = {r["image_id"]: r for r in pages.cropped_pages(table).collect()}
    assert (got[1]["h"], got[1]["w"]) == (50, 50) and (got[2]["h"], got[2]["w"]) == (60, 80)
    assert bytes(got[1]["data"]) == page.reshape(60, 80)[10:60, 10:60].tobytes()
    gray = kernel_udfs.gray_of(spark.createDataFrame([(1, 1, 1, bytes([9, 9, 9]))], kernel_udfs.IMAGE)).first()
    assert bytes(gray["data"]) == bytes([9])


def test_folders_and_small_files(spark, tmp_path):
    for f in ("b/x", "a"):
        (tmp_path / "root" / f).mkdir(parents=True)
        (tmp_path / "root" / f / "model.svg").write_text("<svg/>")
    root = str(tmp_path / "root")
    assert [r["folder"] for r in readers.drawing_folders(spark, root).collect()] == ["a", "b/x"]
    lists = spark.createDataFrame([("/q/1 ",), ("",)], "value string")
    assert [r["folder"] for r in readers.drawing_folders(spark, root, lists).collect()] == ["q/1"]
    assert readers.drawing_folders(spark, root, lists.where("value = ''")).count() == 2
    assert readers.list_files(spark, root, (".SVG",)).count() == 2
    writers.write_text(spark, writers.preprocess_meta("in", "bin", 3, 31, 5), f"{root}/preprocess_meta.json")
    assert '"block_size": 31' in (tmp_path / "root" / "preprocess_meta.json").read_text()
