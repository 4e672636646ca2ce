"""What the physical plans must and must not contain."""

import re

from pyspark.sql import functions as F

from castframe.operators.annotate import annotation_plan
from castframe.operators.search import match_faces, score_all
from workload import fixtures as fx


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_top_k_is_cut_before_each_shuffle(spark, sf_dir):
    plan = plan_of(match_faces(fx.faces(spark, sf_dir), fx.gallery(spark, sf_dir), 5))
    assert plan.count("WindowGroupLimit") == 4 and plan.count("MapInArrow") == 1
    above = plan[: plan.index("MapInArrow")]
    assert above.count("Exchange hashpartitioning") == 2


def test_later_stages_do_not_read_vectors(spark, sf_dir, tmp_path):
    path = str(tmp_path / "matches")
    match_faces(fx.faces(spark, sf_dir), fx.gallery(spark, sf_dir)).write.parquet(path)
    plan = plan_of(annotation_plan(spark.read.parquet(path), fx.gallery(spark, sf_dir), 0.3))
    assert "embedding#" not in re.sub("embedding_path", "", plan.split("FileScan parquet [label")[0])
    assert "GreaterThanOrEqual(similarity_score,0.3)" in plan


def test_scoring_reads_vectors_once_and_keeps_the_rest_in_the_jvm(spark, sf_dir):
    plan = plan_of(score_all(fx.faces(spark, sf_dir), fx.gallery(spark, sf_dir)))
    assert plan.count("ArrowEvalPython") == 1 and "ArrowEvalPython [of_all(embedding#" in plan
    assert plan.count("struct<vec_id") == 1


def test_filters_reach_the_listing(spark, sf_dir, tmp_path):
    path = str(tmp_path / "frames")
    fx.frames(spark, sf_dir).write.parquet(path)
    from castframe.sources.frames import image_frames

    assert "StringEndsWith(path,.jpg)" in plan_of(image_frames(spark.read.parquet(path)).select(F.col("length")))
