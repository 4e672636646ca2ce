"""Edge cases of the column functions, and their properties."""

from pathlib import PurePosixPath

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from castframe.functions import boxes, paths, vectors
from castframe.operators.inference import crop
from castframe.operators.render import outline
from castframe.sources.frames import image_frames


def values(spark, items, column):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(items)], "i int, v string")
    return [r[0] for r in frame.orderBy("i").select(column(F.col("v"))).collect()]


NAMES = ["a.jpg", "a.b.jpg", ".hidden", "a.", "..b", "noext", "x..y", ".a.png", "a b.jpeg"]


def test_stem_and_base_name_follow_path_rules(spark):
    full = [f"/f/d.x/{n}" for n in NAMES] + NAMES
    assert values(spark, full, paths.base_name) == [PurePosixPath(p).name for p in full]
    # A trailing dot is no extension here, whatever the Python version says.
    expected = ["a." if PurePosixPath(p).name == "a." else PurePosixPath(p).stem for p in full]
    assert values(spark, full, paths.stem) == expected


def test_suffix_is_case_sensitive(spark):
    listing = spark.createDataFrame([("a.jpg",), ("b.PNG",), ("c.jpeg",), ("d.txt",), ("e.png",), ("jpg",)], "path string")
    assert sorted(r.path for r in image_frames(listing).collect()) == ["a.jpg", "c.jpeg", "e.png"]


@pytest.mark.parametrize(
    "path, expected",
    [
        ("/d/shot_1/2/f.jpg", "shot_1/2/f.jpg"),
        ("shot_1/f.jpg", "shot_1/f.jpg"),
        ("/a/shot_1/shot_2/f.jpg", "shot_1/shot_2/f.jpg"),
        ("/a/myshot_1/b/f.jpg", "myshot_1/b/f.jpg"),
        ("/a/x/y/shot_.jpg", "shot_.jpg"),
        ("/d/e/g/f.jpg", "e/g/f.jpg"),
        ("/e/f.jpg", "e/f.jpg"),
        ("f.jpg", "f.jpg"),
    ],
)
def test_shot_relative_path(spark, path, expected):
    assert values(spark, [path], paths.shot_relative_path) == [expected]


@pytest.mark.parametrize(
    "path, root, expected",
    [
        ("/f/shot_001/1/a.jpg", "/f", "/o/shot_001/1/a_face_5.pkl"),
        ("/f/shot_001/1/a.jpg", "/f/", "/o/shot_001/1/a_face_5.pkl"),
        ("/g/x/a.jpg", "/f", "/o/a_face_5.pkl"),
        ("/frames2/a.jpg", "/frames", "/o/a_face_5.pkl"),
        ("/f/a.b.jpg", "/f", "/o/a.b_face_5.pkl"),
    ],
)
def test_embedding_output_path(spark, path, root, expected):
    assert values(spark, [path], lambda v: paths.embedding_output_path(v, root, "/o/", F.lit(5))) == [expected]


def test_pixels_labels_and_defaults(spark):
    row = (
        spark.range(1)
        .select(
            boxes.whole_pixels(F.lit(10.9)).alias("a"),
            boxes.whole_pixels(F.lit(-0.9)).alias("b"),
            boxes.label_row(F.lit(12)).alias("top"),
            boxes.label_row(F.lit(100)).alias("row"),
            boxes.match_label(F.lit("Ann"), F.lit(0.87654)).alias("label"),
            boxes.relative_box(*[F.lit(float(v)) for v in (10, 20, 60, 40)], F.lit(100), F.lit(80)).alias("box"),
            boxes.is_drawable(F.lit(1.0), F.lit(float("nan"))).alias("nan"),
            boxes.is_drawable(F.lit(1.0), F.lit(None).cast("double")).alias("null"),
        )
        .first()
    )
    assert (row.a, row.b, row.top, row.row) == (10, 0, 5, 75)
    assert row.label == "Ann (0.877)"
    assert row.box == [0.1, 0.25, 0.5, 0.25]
    assert not row.nan and not row.null


def test_zero_vector_scores_zero(spark):
    frame = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>")
    row = frame.select(
        vectors.cosine(F.col("a"), F.col("b")).alias("s"), vectors.scaled(F.col("a"), vectors.l2_norm(F.col("a"))).alias("u")
    ).first()
    assert row.s == 0.0 and row.u == [0.0, 0.0]
    assert vectors.cosine_matrix(np.zeros((1, 2)), vectors.unit_rows(np.array([[1.0, 0.0]])))[0, 0] == 0.0


def test_unequal_vectors_fail(spark):
    frame = spark.createDataFrame([([0.0, 1.0], [1.0])], "a array<float>, b array<float>")
    with pytest.raises(Exception, match="differ in length"):
        frame.select(vectors.cosine(F.col("a"), F.col("b"))).collect()


@settings(max_examples=50, deadline=None)
@given(
    st.tuples(*[st.floats(-9, 9)] * 2), st.tuples(*[st.floats(0, 12)] * 2), st.integers(1, 6), st.integers(1, 6)
)
def test_crop_pads_with_zero(corner, size, height, width):
    pixels = np.arange(1, height * width + 1, dtype=np.uint8).reshape(height, width, 1)
    box = (*corner, corner[0] + size[0], corner[1] + size[1])
    left, top, right, bottom = (round(v) for v in box)
    cut = crop(pixels, box)
    assert cut.shape[:2] == (bottom - top, right - left)
    for y in range(top, bottom):
        for x in range(left, right):
            inside = 0 <= x < width and 0 <= y < height
            assert cut[y - top, x - left, 0] == (pixels[y, x, 0] if inside else 0)


def test_outline_is_drawn_inward():
    pixels = np.zeros((10, 12, 3), np.uint8)
    outline(pixels, (1, 1, 10, 8), (9, 8, 7), 2)
    painted = pixels[:, :, 0] > 0
    expected = np.zeros((10, 12), bool)
    expected[1:9, 1:11] = True
    expected[3:7, 3:9] = False
    assert (painted == expected).all()
    outline(pixels, (-5, -5, 30, 30), (1, 1, 1), 2)  # wholly outside but for nothing
    with pytest.raises(ValueError):
        outline(pixels, (5, 5, 4, 9), (1, 1, 1), 1)
