"""Files in and out."""

import json
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from castframe.operators.inference import attach_images, crop_faces
from castframe.session import workspace
from castframe.sinks import tables as sinks
from castframe.sources import config, frames, images, tables


def png(path, width, height, pixel=b"\x01\x02\x03"):
    """A tiny RGB image file."""

    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    lines = (b"\0" + pixel * width) * height
    header = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b""))


@pytest.fixture
def tree(tmp_path):
    png(tmp_path / "shot_1" / "a.png", 4, 3)
    png(tmp_path / "shot_1" / "deep" / "b.jpg", 5, 6)
    png(tmp_path / "shot_2" / "_c.jpeg", 2, 2)
    (tmp_path / "shot_2" / "d.PNG").write_bytes(b"x")
    (tmp_path / "shot_2" / "e.txt").write_bytes(b"x")
    (tmp_path / "shot_2" / "bad.png").write_bytes(b"not an image")
    return tmp_path


def names(frame, root):
    return sorted(r.path.replace(str(root) + "/", "") for r in frame.collect())


def test_listing_by_the_file_source(spark, tree):
    listed = frames.list_frames(spark, str(tree), "m")
    assert names(listed, tree) == ["shot_1/a.png", "shot_1/deep/b.jpg", "shot_2/bad.png"]
    assert listed.where("path like '%bad.png'").first() == ("m", str(tree / "shot_2/bad.png"), 12)


def test_listing_by_the_executors(spark, tree):
    roots = spark.createDataFrame([("m", str(tree)), ("none", str(tree / "absent"))], "movie string, folder string")
    listed = frames.walk_frames(roots)
    assert names(listed, tree) == ["shot_1/a.png", "shot_1/deep/b.jpg", "shot_2/_c.jpeg", "shot_2/bad.png"]
    assert {r.movie for r in listed.collect()} == {"m"}
    uri = spark.createDataFrame([("m", "file://" + str(tree))], "movie string, folder string")
    assert names(frames.walk_frames(uri), "file://" + str(tree)) == names(listed, tree)


def test_missing_folders_are_empty_with_a_warning(spark, tmp_path):
    absent = str(tmp_path / "absent")
    with pytest.warns(UserWarning):
        assert frames.list_frames(spark, absent, "m").count() == 0
    with pytest.warns(UserWarning):
        assert tables.list_gallery(spark, absent).count() == 0
    with pytest.warns(UserWarning):
        assert tables.read_gallery(spark, absent).count() == 0


def test_gallery_listing_is_sorted_and_flat(spark, tmp_path):
    for name in ("b.pkl", "a.pkl", "c.txt", "deep/d.pkl"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    assert [r[0].rsplit("/", 1)[1] for r in tables.list_gallery(spark, str(tmp_path)).collect()] == ["a.pkl", "b.pkl"]


def test_images(spark, tree):
    read = images.read_images(spark, str(tree / "shot_*"))
    sizes = {r.image_path.rsplit("/", 1)[1]: (r.width, r.height, r.channels) for r in images.image_dimensions(read).collect()}
    assert sizes["a.png"] == (4, 3, 3) and sizes["b.jpg"] == (5, 6, 3) and "bad.png" not in sizes
    box = spark.createDataFrame([(1, str(tree / "shot_1/a.png"), 1.0, 1.0, 6.0, 3.0)], "face_id long, image_path string, x1 double, y1 double, x2 double, y2 double")
    cut = crop_faces(attach_images(box, read)).first()
    assert (cut.width, cut.height) == (5, 2)
    assert bytes(cut.pixels) == (b"\1\2\3" * 3 + b"\0" * 6) * 2


DETECTIONS = "image_path string, x1 double, y1 double, x2 double, y2 double, confidence double"


def test_detections_csv(spark, tmp_path):
    rows = [('/a "b", c.jpg', 0.1, 1e-7, 3.0, 4.5, 0.30000000000000004), ("/d.jpg", 1.0, 2.0, 3.0, 4.0, 1.0)]
    path = str(tmp_path / "csv")
    sinks.save_detections(spark.createDataFrame(rows, DETECTIONS), path, "csv")
    assert sorted(map(tuple, tables.read_detections(spark, path).collect())) == sorted(rows)


def test_no_detections_still_leave_a_table(spark, tmp_path):
    for fmt in ("parquet", "csv"):
        path = str(tmp_path / fmt)
        sinks.save_detections(spark.createDataFrame([], DETECTIONS), path, fmt)
        back = tables.read_detections(spark, path) if fmt == "csv" else spark.read.schema(DETECTIONS).parquet(path)
        assert back.count() == 0


def test_csv_with_wrong_columns_fails(spark, tmp_path):
    (tmp_path / "x.csv").write_text("path,x1\n/a,1\n")
    with pytest.raises(Exception):
        tables.read_detections(spark, str(tmp_path / "x.csv")).collect()


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_point_lookups_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select(
        F.col("id").alias("face_id"), F.concat(F.lit("/"), F.col("id") % 2).alias("image_path"),
        *[F.lit(1.0).alias(c) for c in ("x1", "y1", "x2", "y2", "confidence")], F.array(F.lit(1.0)).alias("embedding"),
    ).write.parquet(path)
    stored = spark.read.parquet(path)
    one = tables.load_embedding(stored, 3)
    assert one.count() == 1 and "EqualTo(face_id,3)" in plan_of(one)
    some = tables.faces_for_image(stored, "/1")
    assert some.count() == 5 and "EqualTo(image_path,/1)" in plan_of(some) and "embedding" not in plan_of(some)


def test_unreadable_records_are_dropped_and_counted(spark):
    frame = spark.createDataFrame([(1, [1.0]), (2, []), (3, None)], "face_id long, embedding array<float>")
    assert [r.face_id for r in tables.readable_embeddings(frame).collect()] == [1]
    assert tables.embedding_load_report(frame).first() == (1, 2)


def test_one_actor_is_one_folder(spark, tmp_path):
    path = str(tmp_path / "matches")
    columns = tables.MATCHES.fieldNames()
    frame = spark.createDataFrame([(1, 0.5, "/f", 1.0, 1.0, 2.0, 2.0, 0.9, 7, a, f"/g/{a}.pkl") for a in ("x", "y")], tables.MATCHES)
    sinks.save_matches(frame, path)
    back = tables.read_matches(spark, path)
    assert sorted(map(tuple, back.select(*columns).collect())) == sorted(map(tuple, frame.collect()))
    assert "PartitionFilters: [isnotnull(actor_name" in plan_of(back.where("actor_name = 'x'"))


def test_export_is_sorted_by_actor_and_rank(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = [(o, r, 0.5, "/f", 1.0, 1.0, 2.0, 2.0, 0.9, 7, f"a{o}", f"/g/a{o}.pkl") for r in (2, 1) for o in (1, 0)]
    frame = spark.createDataFrame(rows, "actor_ord int, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in tables.MATCHES))
    sinks.export_matches(frame, path)
    text = "".join(p.read_text() for p in sorted((tmp_path / "csv").glob("part-*")))
    lines = [line.split(",") for line in text.splitlines() if not line.startswith("rank")]
    assert [(x[-2], x[0]) for x in lines] == [("a0", "1"), ("a0", "2"), ("a1", "1"), ("a1", "2")]
    assert tables.read_csv(spark, path, tables.MATCHES).count() == 4


def test_config_to_actors(spark, tmp_path):
    movies = [
        {
            "movie": "m1", "actor_embeddings": ["/g/b.pkl", "/g/a.pkl"], "actor_names": {"a.pkl": "Ann"},
            "actor_colors": {"b": {"r": 1, "g": 2, "b": 3}}, "actor_text_colors": {"a": "white"},
        },
        {"movie": "m2", "actor_embeddings": ["/g/a.pkl"], "actor_names": {}, "actor_colors": {}, "actor_text_colors": {}},
        {"movie": "m3", "actor_embeddings": []},
    ]
    (tmp_path / "c.json").write_text("\n".join(map(json.dumps, movies)))
    actors = config.actor_dimension(config.read_config(spark, str(tmp_path / "c.json"))).orderBy("movie", "actor_ord")
    assert [tuple(r) for r in actors.collect()] == [
        ("m1", 0, "/g/b.pkl", "b", None, (1, 2, 3), None),
        ("m1", 1, "/g/a.pkl", "a", "Ann", None, "white"),
        ("m2", 0, "/g/a.pkl", "a", None, None, None),
    ]


def test_workspace_is_the_shared_folder(spark):
    before = workspace(spark)
    assert before == workspace(spark)


def test_sizes_come_from_headers_alone(spark, tmp_path):
    import struct

    png = b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sII", 13, b"IHDR", 300, 200) + b"\x08\x02"
    segment = b"\xff\xe1" + struct.pack(">H", 5002) + b"x" * 5000
    jpeg = b"\xff\xd8\xff\xe0" + struct.pack(">H", 4) + b"ab" + segment + b"\xff\xc2" + struct.pack(">HBHH", 11, 8, 120, 340) + b"rest"
    files = {"a.png": png, "b.jpg": jpeg, "c.jpg": jpeg[:100], "d.png": png[:20], "e.jpg": b"", "f.jpg": b"\xff\xd8no", "g.png": png.replace(struct.pack(">I", 300), struct.pack(">I", 0))}
    for name, body in files.items():
        (tmp_path / name).write_bytes(body)
    (tmp_path / "link.png").symlink_to(tmp_path / "a.png")
    listing = frames.walk_frames(spark.createDataFrame([("m", str(tmp_path))], "movie string, folder string"))
    assert {r.path.rsplit("/", 1)[1]: r.length for r in listing.collect()}["link.png"] == len(png)
    missing = spark.createDataFrame([("m", str(tmp_path / "none.png"), 1)], listing.schema)
    found = images.file_dimensions(listing.unionByName(missing)).collect()
    assert {r.image_path.rsplit("/", 1)[1]: (r.width, r.height) for r in found} == {"a.png": (300, 200), "link.png": (300, 200), "b.jpg": (340, 120)}
