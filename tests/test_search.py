"""Numbering and search: properties, and brute force on small fixtures."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from castframe.functions import vectors
from castframe.operators import numbering, search
from castframe.operators.lsh import match_faces_lsh
from castframe.operators.search import match_faces
from workload import fixtures as fx


@pytest.fixture(scope="module")
def faces(spark, sf_dir):
    return fx.faces(spark, sf_dir).cache()


@pytest.fixture(scope="module")
def gallery(spark, sf_dir):
    return fx.gallery(spark, sf_dir).cache()


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def small(spark, count=400, dims=6, actors=3, hot=0):
    """Random faces; the first ``hot`` are copies of one vector."""
    rng = np.random.default_rng(3)
    data = rng.normal(size=(count, dims)).astype(np.float32)
    data[:hot] = data[0]
    people = rng.normal(size=(actors, dims)).astype(np.float32)
    faces = spark.createDataFrame(
        [("m1" if i % 4 else "m2", i, f"/f/{i // 3}.jpg", (0.0, 0.0, 1.0, 1.0), 0.5, v.tolist()) for i, v in enumerate(data)],
        "movie string, face_id long, image_path string, bbox struct<x1:double,y1:double,x2:double,y2:double>, confidence double, embedding array<float>",
    )
    gallery = spark.createDataFrame(
        [("m1" if j else "m2", j, f"/g/a{j}.pkl", v.tolist()) for j, v in enumerate(people)],
        "movie string, actor_ord int, embedding_path string, embedding array<float>",
    )
    return data.astype(float), people.astype(float), faces, gallery


def brute(data, people, k=None):
    expected = []
    for j, person in enumerate(people):
        score = data @ person / ((np.linalg.norm(data, axis=1) + 1e-8) * (np.linalg.norm(person) + 1e-8))
        ranked = sorted(range(len(data)), key=lambda i: (-round(score[i], 10), i))
        expected += [(j, r + 1, i) for r, i in enumerate(ranked[:k])]
    return expected


@pytest.mark.parametrize("k", [None, 1, 7, 1000])
@pytest.mark.parametrize("hot", [0, 150])
def test_ranks_equal_brute_force(spark, k, hot):
    data, people, faces, gallery = small(spark, hot=hot)
    found = match_faces(faces, gallery, k).select("actor_ord", "rank", "face_id")
    assert sorted(map(tuple, found.collect())) == sorted(brute(data, people, k))


@pytest.mark.parametrize("k", [3, 10_000, 10_001])
@pytest.mark.parametrize("within", [None, "movie"])
def test_every_k_is_a_prefix_also_with_odd_vectors(spark, k, within):
    _, _, faces, gallery = small(spark, hot=150)
    broken = F.transform("embedding", lambda x, i: F.when(i == 2, F.lit(float("nan"))).otherwise(x))
    odd = F.when(F.col("face_id") % 9 == 1, broken).when(F.col("face_id") % 9 == 2, F.lit(None)).when(F.col("face_id") % 9 == 3, F.array())
    faces = faces.withColumn("embedding", odd.otherwise(F.col("embedding")).cast("array<float>"))
    everything = match_faces(faces, gallery, within=within)
    assert everything.where("face_id % 9 in (1, 2, 3)").count() == 0 and everything.count() > 0
    assert rows(match_faces(faces, gallery, k, within)) == rows(everything.where(f"rank <= {k}"))


def test_ordinals_may_repeat_between_movies(spark):
    data, people, faces, gallery = small(spark)
    repeated = gallery.withColumn("actor_ord", F.lit(0))
    for k in (None, 4):
        found = match_faces(faces, repeated, k).select(F.regexp_extract("actor_name", "([0-9]+)", 1).cast("int"), "rank", "face_id")
        assert sorted(map(tuple, found.collect())) == sorted(brute(data, people, k))
    shared = gallery.unionByName(gallery.withColumn("movie", F.lit("m3")))
    assert rows(match_faces(faces, shared, 4)) == rows(match_faces(faces, gallery, 4))


def test_movies_may_differ_in_length(spark):
    _, _, faces, gallery = small(spark)
    short = F.when(F.col("movie") == "m2", F.slice("embedding", 1, 4)).otherwise(F.col("embedding"))
    found = match_faces(faces.withColumn("embedding", short), gallery.withColumn("embedding", short), 5, "movie")
    other = match_faces(faces, gallery, 5, "movie")
    assert rows(found.where("movie = 'm1'")) == rows(other.where("movie = 'm1'")) and found.where("movie = 'm2'").count() == 5


def test_top_k_is_a_prefix_of_all(faces, gallery):
    everything = match_faces(faces, gallery)
    assert rows(match_faces(faces, gallery, 13)) == rows(everything.where("rank <= 13"))


@pytest.mark.parametrize("within", [None, "movie"])
def test_tasks_pass_rows_on_in_one_scan(faces, gallery, monkeypatch, within):
    expected = rows(match_faces(faces, gallery, 13, within))
    monkeypatch.setattr(search, "MAX_KEPT_ROWS", 20)
    monkeypatch.setattr(search, "_CELLS", 100)
    few = faces.sparkSession.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    faces.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "25")
    try:
        found = match_faces(faces, gallery, 13, within)
        assert found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("MapInArrow") == 1
        assert rows(found) == expected
    finally:
        faces.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", few)


@pytest.mark.parametrize("k", [None, 5])
@pytest.mark.parametrize("within", [None, "movie"])
def test_gallery_in_blocks(faces, gallery, k, within):
    whole = match_faces(faces, gallery, k, within)
    for limit in (1500, 5000):  # actors of one movie apart, and together
        passes = list(search.gallery_passes(faces, search.keyed_gallery(gallery, within), within, limit))
        sizes = [sum(len(keys) for keys, _ in p.block.matrices.values()) for p in passes]
        assert len(passes) > 1 and sum(sizes) == gallery.count()
        assert max(sizes) <= limit // (8 * 64 + 64)
        assert rows(match_faces(faces, gallery, k, within, max_bytes=limit)) == rows(whole)


@pytest.mark.parametrize("within", [None, "movie"])
def test_long_score_lists_are_split(faces, gallery, within, monkeypatch):
    expected = rows(match_faces(faces, gallery, None, within))
    monkeypatch.setattr(search, "MAX_LIST", 2)
    assert len(list(search.gallery_passes(faces, search.keyed_gallery(gallery, within), within, 1 << 20, max_list=2))) > 1
    assert rows(match_faces(faces, gallery, None, within)) == expected


def test_passes_prune_a_table_stored_by_movie(spark, faces, gallery, tmp_path):
    path = str(tmp_path / "faces")
    faces.write.partitionBy("movie").parquet(path)
    stored = spark.read.parquet(path)
    passes = list(search.gallery_passes(stored, search.keyed_gallery(gallery, "movie"), "movie", 5000))
    counted = [p.faces.count() for p in passes]
    assert sum(counted) == faces.count() and max(counted) < faces.count()
    plan = passes[0].faces._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(movie" in plan or "PartitionFilters: [(pmod" in plan


def test_top_k_is_reduced_in_two_steps(faces, gallery, monkeypatch):
    expected = rows(match_faces(faces, gallery, 4))
    monkeypatch.setattr(search, "MAX_RANK_ROWS", 12)  # three salts
    assert rows(match_faces(faces.repartition(6), gallery, 4)) == expected


def test_faces_meet_only_their_movie(faces, gallery):
    found = match_faces(faces, gallery, within="movie").join(gallery.select("actor_ord", F.col("movie").alias("home")), "actor_ord")
    assert found.where("movie <> home").count() == 0
    assert found.count() == faces.join(gallery.select("movie"), "movie").count()


def test_result_ignores_partitioning(faces, gallery):
    expected = rows(match_faces(faces, gallery, 9))
    assert rows(match_faces(faces.repartition(7), gallery, 9)) == expected
    assert rows(match_faces(faces.repartition(1), gallery, 9)) == expected


def test_both_scoring_routes_agree(faces, gallery):
    kernel = search.score_all(faces.select("face_id", "embedding"), gallery)
    pairs = faces.select("face_id", "embedding").join(
        F.broadcast(gallery.select("actor_ord", F.col("embedding").alias("reference"))), F.lit(True)
    )
    built_in = pairs.select("face_id", "actor_ord", vectors.cosine(F.col("embedding"), F.col("reference")).alias("other"))
    both = kernel.join(built_in, ["face_id", "actor_ord"])
    assert both.count() == faces.count() * gallery.count()
    assert both.where(F.abs(F.col("similarity_score") - F.col("other")) > 1e-9).count() == 0


def test_unequal_vectors_fail(spark):
    _, _, faces, gallery = small(spark)
    short = faces.withColumn("embedding", F.when(F.col("face_id") == 5, F.slice("embedding", 1, 3)).otherwise(F.col("embedding")))
    for k in (None, 3):
        with pytest.raises(Exception, match="must have 6 elements"):
            match_faces(short, gallery, k).collect()
    with pytest.raises(ValueError, match="gallery vectors"):
        match_faces(faces, gallery.withColumn("embedding", F.slice("embedding", 1, F.col("actor_ord") + 1)))
    with pytest.raises(ValueError, match="positive"):
        match_faces(faces, gallery, 0)


@pytest.mark.parametrize("k", [None, 3])
def test_empty_sides(spark, k):
    _, _, faces, gallery = small(spark)
    assert match_faces(faces.where("false"), gallery, k).count() == 0
    assert match_faces(faces, gallery.where("false"), k).count() == 0


def test_lsh_recall(faces, gallery):
    keys = ["actor_ord", "face_id"]
    exact = match_faces(faces, gallery, 10)
    near = match_faces_lsh(faces, gallery, 10)
    hits = exact.select(*keys, F.col("similarity_score").alias("s")).join(near, keys)
    assert hits.count() >= 0.9 * exact.count()
    assert hits.where(F.abs(F.col("s") - F.col("similarity_score")) > 1e-9).count() == 0
    assert near.groupBy(*keys).count().where("count > 1").count() == 0


def test_lsh_with_narrow_buckets_scores_few_pairs(faces, gallery):
    keys = ["actor_ord", "face_id"]
    near = match_faces_lsh(faces, gallery, 100, tables=2, bucket=0.05)
    assert 0 < near.count() < 100 * gallery.count()
    exact = match_faces(faces, gallery).select(*keys, F.col("similarity_score").alias("s"))
    assert near.join(exact, keys).where(F.abs(F.col("s") - F.col("similarity_score")) > 1e-9).count() == 0
    # Every reference vector is itself a face, and always meets itself.
    assert near.where("rank = 1 and similarity_score > 0.999").count() == gallery.count()
    inside = match_faces_lsh(faces, gallery, 10, within="movie")
    assert inside.count() > 0
    assert inside.join(gallery.select("actor_ord", F.col("movie").alias("home")), "actor_ord").where("movie <> home").count() == 0


def test_union_and_preview(faces, gallery):
    everything = match_faces(faces, gallery)
    runs = [match_faces(faces, gallery.where(c)) for c in ("actor_ord < 4", "actor_ord >= 4")]
    columns = search.MATCHES.fieldNames()
    assert rows(search.union_matches(*runs)) == rows(everything.select(*columns))
    assert search.preview(everything, 5).count() == 5 * gallery.count()


@pytest.mark.parametrize("partitions", [1, 5, 16])
def test_face_ids_are_dense_and_stable(spark, sf_dir, partitions):
    raw = fx.raw_detections(spark, sf_dir).repartition(partitions)
    numbered = fx.number_detections(raw)
    assert numbered.agg(F.min("face_id"), F.max("face_id"), F.countDistinct("face_id")).first() == (
        0, raw.count() - 1, raw.count(),
    )
    assert rows(numbered) == rows(fx.detections(spark, sf_dir))


def test_face_ids_are_kept(spark, sf_dir):
    stored = fx.detections(spark, sf_dir)
    assert numbering.assign_face_ids(stored) is stored


def test_face_ids_without_detection_number(spark):
    frame = spark.createDataFrame([("/b", 2.0), ("/a", 1.0), ("/b", 1.0)], "image_path string, x1 double")
    assert rows(numbering.assign_face_ids(frame)) == [("/a", 1.0, 0), ("/b", 1.0, 1), ("/b", 2.0, 2)]


def test_number_rows_with_a_hot_and_a_null_group(spark):
    frame = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 97 == 1, None).otherwise(F.concat(F.lit("g"), F.col("id") % 11)).alias("g"),
        F.xxhash64("id").alias("v"),
    )
    numbered = numbering.number_rows(frame, [F.col("v")], "n", ["g"])
    wrong = numbered.withColumn("w", F.row_number().over(Window.partitionBy("g").orderBy("v"))).where("n <> w")
    assert numbered.count() == 1000 and wrong.count() == 0
