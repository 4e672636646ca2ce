"""What must grow no faster than the input: tasks, shuffled rows, pixels."""

import numpy as np
from pyspark.sql import functions as F

from castframe.operators import inference
from castframe.operators.numbering import number_rows
from castframe.sinks import images
from castframe.sources.listing import FrameReader, folder_listing
from workload import fixtures as fx
from workload import queries, stubs


def test_folders_share_tasks(spark, tmp_path):
    for n in range(60):
        folder = tmp_path / f"shot_{n}" / "inner"
        folder.mkdir(parents=True)
        (folder / f"{n}.jpg").write_bytes(b"x" * n)
    roots = spark.createDataFrame([("m", str(tmp_path))], "movie string, folder string")
    listed = folder_listing(spark, roots, tasks=7)
    assert listed.rdd.getNumPartitions() == 7
    assert sorted(r.length for r in listed.collect()) == list(range(60))
    tasks = FrameReader([["m", str(tmp_path)]], 7).partitions()
    assert sorted(len(t.folders) for t in tasks) == [8, 8, 9, 9, 9, 9, 9]  # the root's own files too


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_numbering_shuffles_no_rows_for_their_offsets(spark):
    numbered = number_rows(spark.range(1000).withColumn("wide", F.repeat(F.lit("x"), 100)), [F.desc("id")], "n")
    assert "BroadcastHashJoin" in plan_of(numbered) and "hashpartitioning" not in plan_of(numbered)
    assert numbered.where(F.col("n") != 1000 - F.col("id")).count() == 0


def test_lines_are_numbered_before_they_are_widened(spark, sf_dir):
    stored = numbering_input(fx.numbered_detections(spark, sf_dir))
    assert "image_path" not in stored and {*fx.LINE_ORDER} <= stored
    raw = fx.number_detections(fx.raw_detections(spark, sf_dir))
    same = fx.detections(spark, sf_dir).select(*raw.columns)
    assert raw.exceptAll(same).isEmpty() and same.exceptAll(raw).isEmpty()


def numbering_input(df):
    """The columns of the table that the numbering has written."""
    path = next(f for f in df.inputFiles() if "numbered-" in f)
    return set(df.sparkSession.read.parquet(path).columns)


def test_corners_are_rounded_for_a_whole_batch_as_for_one_box():
    usual = [(0.5, 1.5, 2.5, 3.5), (0, 0, 4, 4), (1, 1, 1, 1), (-0.4, -0.5, 3, 3)]
    odd = [(3, 3, 2, 4), (-1, 0, 2, 2), (0, 0, float("inf"), 1), (0, float("nan"), 1, 1), (0, 0, 1e12, 1)]
    corners = inference._whole_corners(np.array(usual + odd, np.float64))
    assert corners[len(usual) :] == [None] * len(odd)
    pixels = np.arange(5 * 5 * 3).reshape(5, 5, 3)
    for box, (x1, y1, x2, y2) in zip(usual, corners):
        assert np.array_equal(pixels[y1:y2, x1:x2], inference.crop(pixels, box))


def test_embedding_passes_its_rows_through(spark, sf_dir):
    plan = plan_of(inference.embed(fx.detections(spark, sf_dir), stubs.size_embedder, "m", stubs.read_some_frames))
    assert "MapInArrow" in plan and "MapInPandas" not in plan


def test_pixels_stay_in_the_task_that_draws_them(spark, sf_dir, tmp_path, monkeypatch):
    seen, draw = [], images.draw_images
    monkeypatch.setattr(images, "draw_images", lambda make, *rest: draw(lambda store: seen.append(make(store)) or seen[-1], *rest))
    rows = queries.QUERIES["published_images"](spark, sf_dir).collect()
    assert "pixels" not in seen[0].columns and "file" in seen[0].columns
    done = [r for r in rows if r.status == "processed"]
    assert done and all(r.file_bytes == r.height for r in done)

    def full(file, pixels):
        if file.endswith("1.jpg"):
            raise OSError("disk full")
        stubs.write_size(file, pixels)

    path = str(tmp_path / "images")
    draw(lambda store: queries._rendered(spark, sf_dir, store), path, full)
    lost = [r for r in images.published_images(spark, path).collect() if r.error == "OSError: disk full"]
    assert lost and all((r.status, r.faces_drawn, r.file, r.height) == ("error", 0, None, None) for r in lost)
