"""The same queries in SQL, over the same tables."""

from __future__ import annotations

VIEWS = {
    "fx_detections": """
SELECT CAST(row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS BIGINT) AS face_id,
       concat('movie_', l_orderkey % 3) AS movie, l_orderkey AS frame,
       concat('/frames/movie_', l_orderkey % 3, '/shot_', CAST(floor(l_orderkey / 100) AS BIGINT), '/', l_orderkey % 4, '/', l_orderkey, '.jpg') AS image_path,
       CAST(l_partkey % 1200 AS DOUBLE) + l_discount AS x1,
       CAST(l_suppkey % 650 AS DOUBLE) + l_discount AS y1,
       CAST(l_partkey % 1200 AS DOUBLE) + l_discount + 20 + l_quantity AS x2,
       CAST(l_suppkey % 650 AS DOUBLE) + l_discount + 20 + l_quantity AS y2,
       1.0E0 - l_discount * 5 AS confidence
FROM lineitem""",
    "fx_frames": """
SELECT concat('movie_', o_orderkey % 3) AS movie, o_orderkey AS frame,
       concat('/frames/movie_', o_orderkey % 3, '/shot_', CAST(floor(o_orderkey / 100) AS BIGINT), '/', o_orderkey % 4, '/', o_orderkey,
              CASE WHEN o_orderkey % 50 = 49 THEN '.JPG' WHEN o_orderkey % 50 = 48 THEN '.txt' ELSE '.jpg' END) AS path,
       CASE WHEN o_orderkey % 40 = 7 THEN CAST(52428801 AS BIGINT) WHEN o_orderkey % 40 = 8 THEN CAST(52428800 AS BIGINT)
            ELSE CAST(1000 + o_orderkey AS BIGINT) END AS length,
       CASE WHEN o_orderdate < TIMESTAMP '1998-05-01' THEN 0 ELSE 1 END AS delivery
FROM orders""",
    "fx_listed": """
SELECT * FROM fx_frames WHERE path LIKE '%.jpg' OR path LIKE '%.png' OR path LIKE '%.jpeg'""",
    "fx_faces": """
SELECT vec_id AS face_id, embedding::DOUBLE[] AS embedding,
       concat('movie_', CAST(floor(vec_id / 2) AS BIGINT) % 3) AS movie,
       concat('/frames/movie_', CAST(floor(vec_id / 2) AS BIGINT) % 3, '/shot_', CAST(floor(vec_id / 20) AS BIGINT), '/',
              CAST(floor(vec_id / 2) AS BIGINT) % 4, '/', CAST(floor(vec_id / 2) AS BIGINT), '.jpg') AS image_path,
       CAST(vec_id * 37 % 1200 AS DOUBLE) + 0.75E0 AS x1, CAST(vec_id * 53 % 650 AS DOUBLE) + 0.25E0 AS y1,
       CAST(vec_id * 37 % 1200 AS DOUBLE) + 40.75E0 AS x2, CAST(vec_id * 53 % 650 AS DOUBLE) + 50.25E0 AS y2,
       0.5E0 + CAST(vec_id % 50 AS DOUBLE) / 100 AS confidence
FROM embeddings""",
    "fx_gallery": """
SELECT concat('movie_', label % 3) AS movie, label AS actor_ord, concat('actor_', label, '_face_0') AS actor_name,
       concat('/gallery/actor_', label, '_face_0.pkl') AS embedding_path, embedding::DOUBLE[] AS embedding,
       CASE WHEN label % 2 = 0 THEN concat('Actor ', label) END AS display_name,
       CASE WHEN label % 3 = 0 THEN label * 20 END AS red,
       CASE WHEN label % 3 = 0 THEN 'white' END AS text_color
FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rn FROM embeddings) t
WHERE rn = 1""",
    "fx_images": """
SELECT DISTINCT image_path, 1280 AS width, 720 AS height,
       CASE WHEN CAST(floor(face_id / 2) AS BIGINT) % 40 = 7 THEN CAST(52428801 AS BIGINT) ELSE CAST(52428800 AS BIGINT) END AS length
FROM fx_faces""",
    "fx_done": """
SELECT d.* FROM fx_detections d WHERE face_id IN (SELECT vec_id FROM embeddings)""",
    "scored": """
SELECT f.*, g.movie AS actor_movie, g.actor_ord, g.actor_name, g.embedding_path, g.display_name, g.red, g.text_color,
       round(list_dot_product(f.embedding, g.embedding) /
             ((sqrt(list_dot_product(f.embedding, f.embedding)) + 1e-8) * (sqrt(list_dot_product(g.embedding, g.embedding)) + 1e-8)), 12) AS score
FROM fx_faces f CROSS JOIN fx_gallery g""",
    "matches": """
SELECT *, row_number() OVER (PARTITION BY actor_ord ORDER BY score DESC, face_id) AS rank FROM scored""",
    "movie_matches": """
SELECT *, row_number() OVER (PARTITION BY actor_ord ORDER BY score DESC, face_id) AS rank FROM scored WHERE movie = actor_movie""",
    "samples": """
SELECT m.*, printf('%s (%.3f)', m.actor_name, m.score) AS label,
       round(x1 / width, 6) AS x, round(y1 / height, 6) AS y, round((x2 - x1) / width, 6) AS w, round((y2 - y1) / height, 6) AS h
FROM matches m JOIN fx_images USING (image_path)""",
    "drawn": """
SELECT image_path AS frame_image_path, regexp_extract(image_path, '/(shot_.*)$', 1) AS save_path, actor_ord, rank, face_id,
       CAST(trunc(x1) AS BIGINT) AS x1, CAST(trunc(y1) AS BIGINT) AS y1, CAST(trunc(x2) AS BIGINT) AS x2, CAST(trunc(y2) AS BIGINT) AS y2,
       printf('%s (%.3f)', coalesce(display_name, actor_name), score) AS label, red, coalesce(text_color, 'black') AS text_color
FROM matches WHERE score >= 0.2""",
    "usable": """
SELECT DISTINCT d.frame_image_path, i.length,
       CASE WHEN i.length IS NULL THEN 'missing' WHEN i.length > 52428800 THEN 'too_large' ELSE 'ok' END AS status
FROM drawn d LEFT JOIN fx_images i ON i.image_path = d.frame_image_path""",
    "rendered": """
SELECT u.frame_image_path, any_value(d.save_path) AS save_path,
       CASE WHEN u.status = 'ok' THEN 'processed' ELSE 'skipped' END AS status,
       CASE WHEN u.status <> 'ok' THEN u.status END AS error,
       CASE WHEN u.status = 'ok' THEN count(*) ELSE 0 END AS faces_drawn,
       CASE WHEN u.status = 'ok' THEN CAST(1280 AS BIGINT) END AS width,
       CASE WHEN u.status = 'ok' THEN CAST(720 AS BIGINT) END AS height,
       CASE WHEN u.status = 'ok' THEN CAST(3 AS BIGINT) END AS channels
FROM drawn d JOIN usable u USING (frame_image_path) GROUP BY u.frame_image_path, u.status""",
    "found": """
SELECT movie, frame, path AS image_path, CAST(n AS BIGINT) AS det_no,
       CAST(frame % 1200 + n AS DOUBLE) AS x1, CAST(frame % 650 + n AS DOUBLE) AS y1,
       CAST(frame % 1200 + n + 20 AS DOUBLE) AS x2, CAST(frame % 650 + n + 30 AS DOUBLE) AS y2,
       1 - n * 0.25E0 AS confidence, delivery
FROM fx_listed, generate_series(0, 2) s(n) WHERE n < frame % 3""",
    "embedded": """
SELECT movie, face_id, image_path, 'stub' AS model,
       CASE WHEN frame % 97 = 5 THEN 'error' ELSE 'saved' END AS status,
       CASE WHEN frame % 97 = 5 THEN 'OSError: broken image' END AS error,
       CASE WHEN frame % 97 <> 5 THEN frame END AS frame,
       CASE WHEN frame % 97 <> 5 THEN CAST(round_even(x2, 0) - round_even(x1, 0) AS BIGINT) END AS width,
       CASE WHEN frame % 97 <> 5 THEN CAST(round_even(y2, 0) - round_even(y1, 0) AS BIGINT) END AS height
FROM fx_detections""",
    "waves": """
SELECT *, CAST(row_number() OVER (ORDER BY image_path, det_no) - 1 AS BIGINT) AS face_id,
       list_transform(range(64), lambda d: CAST((frame * 7 + d * d * 5) % 101 - 50 AS DOUBLE)) AS embedding
FROM found""",
    "wave_matches": """
SELECT w.*, g.actor_ord, g.actor_name, g.display_name, g.text_color, s.score,
       row_number() OVER (PARTITION BY g.actor_ord ORDER BY s.score DESC, w.face_id) AS rank
FROM waves w JOIN fx_gallery g USING (movie), LATERAL (SELECT
       round(list_dot_product(w.embedding, g.embedding) /
             ((sqrt(list_dot_product(w.embedding, w.embedding)) + 1e-8) * (sqrt(list_dot_product(g.embedding, g.embedding)) + 1e-8)), 12) AS score) s""",
    "pixels": """
SELECT vec_id AS face_id, label,
       vec_id % 7 - 1.5E0 AS x1, vec_id % 5 - 0.5E0 AS y1,
       vec_id % 7 - 1.5E0 + 3 + vec_id % 4 AS x2, vec_id % 5 - 0.5E0 + 2 + vec_id % 3 AS y2,
       list_transform(embedding, lambda v: CAST(floor((v::DOUBLE + 1) * 127) AS BIGINT)) AS grey
FROM embeddings""",
    "corners": """
SELECT face_id, grey, CAST(round_even(x1, 0) AS BIGINT) AS l, CAST(round_even(y1, 0) AS BIGINT) AS t,
       CAST(round_even(x2, 0) AS BIGINT) AS r, CAST(round_even(y2, 0) AS BIGINT) AS b
FROM pixels WHERE label <> 0""",
}

# Which views each view is built from.
USES = {
    "fx_listed": ["fx_frames"],
    "fx_images": ["fx_faces"],
    "fx_done": ["fx_detections"],
    "scored": ["fx_faces", "fx_gallery"],
    "matches": ["scored"],
    "movie_matches": ["scored"],
    "samples": ["matches", "fx_images"],
    "drawn": ["matches"],
    "usable": ["drawn", "fx_images"],
    "rendered": ["drawn", "usable"],
    "found": ["fx_listed"],
    "embedded": ["fx_detections"],
    "waves": ["found"],
    "wave_matches": ["waves", "fx_gallery"],
    "corners": ["pixels"],
}


def _sql(body: str, *views: str) -> str:
    """The query with the views it needs as leading CTEs."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in USES.get(name, []):
            add(other)
        if name not in ordered:
            ordered.append(name)

    for view in views:
        add(view)
    ctes = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in ordered)
    return (f"WITH {ctes}\n" if ctes else "") + body.strip()


_MATCH = """rank, round(score, 6) AS similarity_score, round(x1, 6) AS face_x1, round(y1, 6) AS face_y1, round(x2, 6) AS face_x2,
       round(y2, 6) AS face_y2, round(confidence, 6) AS face_confidence, image_path AS frame_image_path, face_id, actor_name,
       embedding_path AS actor_embedding_path"""
_BOX = "round(x1, 6) AS x1, round(y1, 6) AS y1, round(x2, 6) AS x2, round(y2, 6) AS y2"
_COLOR = "coalesce(CAST(red AS BIGINT), 255) AS r, CASE WHEN red IS NULL THEN 255 ELSE 50 END::BIGINT AS g, CASE WHEN red IS NULL THEN 0 ELSE 50 END::BIGINT AS b"

ORACLE = {
    "frames_by_extension": _sql("SELECT path, length FROM fx_listed", "fx_listed"),
    "detections_roundtrip": _sql(f"SELECT face_id, image_path, {_BOX}, round(confidence, 6) AS confidence FROM fx_detections", "fx_detections"),
    "load_face_embeddings": _sql(
        """SELECT face_id, image_path, CAST(len(e.embedding) AS BIGINT) AS dims, round(confidence, 6) AS confidence
           FROM fx_detections d JOIN embeddings e ON e.vec_id = d.face_id WHERE len(e.embedding) > 0""",
        "fx_detections",
    ),
    "embedding_load_report": _sql(
        """SELECT CAST(count(e.vec_id) AS BIGINT) AS loaded, CAST(count(*) - count(e.vec_id) AS BIGINT) AS dropped
           FROM fx_detections d LEFT JOIN embeddings e ON e.vec_id = d.face_id""",
        "fx_detections",
    ),
    "embedding_by_face_id": _sql(
        """SELECT face_id, image_path, round(list_sum(embedding), 6) AS total, round(confidence, 6) AS confidence
           FROM fx_faces WHERE face_id IN (SELECT face_id FROM matches WHERE score >= 0.2)""",
        "fx_faces",
        "matches",
    ),
    "listed_frames": """
SELECT concat('movie_', c_nationkey % 3) AS movie,
       concat('/movie_', c_nationkey % 3, '/shot_', c_custkey // 100, '/', c_custkey, CASE WHEN c_custkey % 5 = 2 THEN '.jpg' ELSE '.png' END) AS path,
       CAST(24 AS BIGINT) AS length
FROM customer WHERE c_custkey % 5 > 1""",
    "frame_file_sizes": """
SELECT concat('/movie_', c_nationkey % 3, '/shot_', c_custkey // 100, '/', c_custkey, CASE WHEN c_custkey % 5 = 2 THEN '.jpg' ELSE '.png' END) AS image_path,
       c_custkey % 1280 + 1 AS width, c_custkey % 720 + 1 AS height
FROM customer WHERE c_custkey % 5 > 1""",
    "exported_matches": _sql(f"SELECT {_MATCH} FROM matches", "matches"),
    "nothing_to_draw": """
SELECT count(*) AS processed, count(*) AS skipped, count(*) AS errors, count(*) AS faces_drawn FROM embeddings WHERE false""",
    "best_matches_kept_up_to_date": _sql(f"SELECT {_MATCH} FROM matches WHERE rank <= 20", "matches"),
    "united_actor_summary": _sql(
        """SELECT actor_name, count(*) AS count, round(avg(score), 4) AS mean, round(max(score), 4) AS max, round(min(score), 4) AS min,
                  true AS images_within_error
           FROM matches GROUP BY actor_name""",
        "matches",
    ),
    "load_gallery": _sql(
        """SELECT embedding_path, CAST(place - 1 AS BIGINT) AS place, round(CAST(embedding[place] AS FLOAT)::DOUBLE, 6) AS value
           FROM (SELECT embedding_path, embedding, unnest(range(1, len(embedding) + 1)) AS place FROM fx_gallery)""",
        "fx_gallery",
    ),
    "gallery_listing": _sql("SELECT embedding_path, actor_name FROM fx_gallery ORDER BY embedding_path", "fx_gallery"),
    "actor_dimension": _sql(
        """SELECT movie, row_number() OVER (PARTITION BY movie ORDER BY actor_ord) - 1 AS actor_ord, embedding_path, actor_name,
                  display_name, CAST(red AS BIGINT) AS r, CASE WHEN red IS NOT NULL THEN CAST(50 AS BIGINT) END AS g,
                  CASE WHEN red IS NOT NULL THEN CAST(50 AS BIGINT) END AS b, text_color
           FROM fx_gallery""",
        "fx_gallery",
    ),
    "build_gallery": _sql(
        """SELECT g.movie, CAST(g.actor_ord AS BIGINT) AS actor_ord,
                  concat('/embeddings/', substring(replace(f.image_path, '.jpg', ''), 9), '_face_', f.face_id, '.pkl') AS embedding_path,
                  round(list_sum(f.embedding), 6) AS total
           FROM fx_gallery g JOIN (SELECT label, min(vec_id) AS face_id FROM embeddings GROUP BY label) e ON e.label = g.actor_ord
           JOIN fx_faces f USING (face_id)""",
        "fx_gallery",
        "fx_faces",
    ),
    "image_dimensions": _sql(
        """SELECT concat('/pixels/', vec_id, '.png') AS image_path, CAST(8 AS BIGINT) AS width, CAST(8 AS BIGINT) AS height,
                  CAST(1 AS BIGINT) AS channels
           FROM embeddings WHERE label <> 0"""
    ),
    "embedding_table_layout": _sql(
        "SELECT movie, count(*) AS faces, min(face_id) AS first_id, max(face_id) AS last_id FROM fx_faces GROUP BY movie", "fx_faces"
    ),
    "normalized_embeddings": _sql(
        """SELECT face_id, round(norm, 6) AS norm, CAST(place - 1 AS BIGINT) AS place, round(embedding[place] / (norm + 1e-8), 6) AS value
           FROM (SELECT face_id, embedding, sqrt(list_dot_product(embedding, embedding)) AS norm,
                        unnest(range(1, len(embedding) + 1)) AS place FROM fx_faces)""",
        "fx_faces",
    ),
    "matches_for_one_actor": _sql(f"SELECT {_MATCH} FROM matches WHERE actor_name = 'actor_3_face_0'", "matches"),
    "labelling_samples": _sql(
        """SELECT image_path AS filepath, row_number() OVER (PARTITION BY image_path ORDER BY actor_ord, rank) - 1 AS place, label,
                  x, y, w, h, round(score, 6) AS confidence
           FROM samples""",
        "samples",
    ),
    "embedding_output_path": _sql(
        """SELECT face_id, concat('/embeddings/', CASE WHEN movie = 'movie_1' THEN
                  concat('shot_', CAST(floor(frame / 100) AS BIGINT), '/', frame % 4, '/') ELSE '' END, frame, '_face_', face_id, '.pkl') AS output_path
           FROM fx_detections""",
        "fx_detections",
    ),
    "path_parts": _sql(
        "SELECT path, string_split(path, '/')[-1] AS base_name, CAST(frame AS VARCHAR) AS stem FROM fx_frames", "fx_frames"
    ),
    "shot_relative_path": _sql(
        """SELECT path, concat(CASE WHEN length % 2 = 0 THEN '' ELSE 'shot_' END, CAST(floor(frame / 100) AS BIGINT), '/', frame % 4, '/',
                  string_split(path, '/')[-1]) AS relative_path
           FROM fx_frames""",
        "fx_frames",
    ),
    "faces_for_image": _sql(
        """SELECT image_path, face_id, round(confidence, 6) AS confidence, round(x1, 6) AS box_x1, round(y1, 6) AS box_y1,
                  round(x2, 6) AS box_x2, round(y2, 6) AS box_y2
           FROM fx_detections WHERE image_path IN (SELECT path FROM fx_listed)""",
        "fx_detections",
        "fx_listed",
    ),
    "annotation_labels": _sql(
        """SELECT face_id, actor_name, coalesce(display_name, actor_name) AS display_name,
                  printf('%s (%.3f)', coalesce(display_name, actor_name), score) AS label
           FROM matches""",
        "matches",
    ),
    "annotation_colors": _sql(
        f"SELECT face_id, actor_name, {_COLOR}, coalesce(text_color, 'black') AS text_color FROM matches", "matches"
    ),
    "relative_boxes": _sql(
        "SELECT image_path AS filepath, face_id, label, round(score, 6) AS confidence, x, y, w, h FROM samples", "samples"
    ),
    "cosine_scores": _sql(
        "SELECT face_id, CAST(actor_ord AS BIGINT) AS actor_ord, round(score, 6) AS similarity_score FROM scored", "scored"
    ),
    "crop_shapes": _sql(
        """SELECT face_id, r - l AS width, b - t AS height, CAST(3 AS BIGINT) AS channels,
                  md5(unhex(coalesce(string_agg(repeat(CASE WHEN x BETWEEN 0 AND 7 AND y BETWEEN 0 AND 7
                      THEN lpad(hex(grey[y * 8 + x + 1]), 2, '0') ELSE '00' END, 3), '' ORDER BY y, x), ''))) AS digest
           FROM (SELECT *, unnest(range(l, r)) AS x FROM (SELECT *, unnest(range(t, b)) AS y FROM corners))
           GROUP BY face_id, l, r, t, b""",
        "corners",
    ),
    "frames_without_faces": _sql(
        "SELECT path, length FROM fx_listed WHERE path NOT IN (SELECT image_path FROM fx_detections)", "fx_listed", "fx_detections"
    ),
    "matches_above_threshold": _sql(f"SELECT {_MATCH} FROM matches WHERE score >= 0.2", "matches"),
    "matches_no_threshold": _sql(f"SELECT {_MATCH} FROM matches", "matches"),
    "pending_embeddings": _sql(
        "SELECT movie, face_id, image_path FROM fx_detections WHERE face_id NOT IN (SELECT face_id FROM fx_done)", "fx_done"
    ),
    "annotatable_images": _sql(
        """SELECT m.image_path AS frame_image_path, f.length,
                  CASE WHEN f.length IS NULL THEN 'missing' WHEN f.length > 52428800 THEN 'too_large' ELSE 'ok' END AS status
           FROM (SELECT DISTINCT image_path FROM matches) m LEFT JOIN fx_listed f ON f.path = m.image_path""",
        "matches",
        "fx_listed",
    ),
    "actor_matches": _sql(f"SELECT {_MATCH} FROM matches", "matches"),
    "actor_topk": _sql(f"SELECT {_MATCH} FROM matches WHERE rank <= 20", "matches"),
    # With these parameters a pair of the top 20 misses all tables about once in a million.
    "actor_topk_lsh": _sql(f"SELECT {_MATCH} FROM matches WHERE rank <= 20", "matches"),
    "detections_with_embeddings": _sql(
        f"""SELECT d.face_id, d.image_path, {_BOX.replace('(x', '(d.x').replace('(y', '(d.y')}, round(list_sum(e.embedding::DOUBLE[]), 6) AS total
            FROM fx_detections d JOIN embeddings e ON e.vec_id = d.face_id""",
        "fx_detections",
    ),
    "bucketed_join": _sql(
        """SELECT d.face_id, d.image_path, CAST(coalesce(len(e.embedding), 0) AS BIGINT) AS dims
           FROM fx_detections d LEFT JOIN embeddings e ON e.vec_id = d.face_id""",
        "fx_detections",
    ),
    "embedding_coverage": _sql(
        """SELECT count(d.face_id) AS detected, count(e.vec_id) AS embedded,
                  count(*) FILTER (d.face_id IS NOT NULL AND e.vec_id IS NOT NULL) AS both,
                  count(*) FILTER (e.vec_id IS NULL) AS not_embedded, count(*) FILTER (d.face_id IS NULL) AS not_detected
           FROM fx_detections d FULL JOIN embeddings e ON e.vec_id = d.face_id""",
        "fx_detections",
    ),
    "actor_summary": _sql(
        """SELECT actor_name, count(*) AS count, round(avg(score), 4) AS mean, round(max(score), 4) AS max, round(min(score), 4) AS min
           FROM matches GROUP BY actor_name""",
        "matches",
    ),
    "faces_per_actor": _sql(
        """SELECT actor_name, coalesce(any_value(display_name), actor_name) AS display_name, count(*) AS faces
           FROM matches WHERE score >= 0.2 GROUP BY actor_name ORDER BY faces DESC, actor_name""",
        "matches",
    ),
    "unique_images": _sql("SELECT count(DISTINCT image_path) AS images FROM matches WHERE score >= 0.2", "matches"),
    "faces_per_image": _sql(
        """SELECT image_path AS frame_image_path, count(*) AS boxes, count(DISTINCT face_id) AS faces,
                  arg_max(actor_name, (actor_ord, rank)) AS top_actor
           FROM matches GROUP BY image_path""",
        "matches",
    ),
    "annotation_plan": _sql(
        f"""SELECT frame_image_path, save_path, face_id, label, text_color, CAST(actor_ord AS BIGINT) AS actor_ord, rank, x1, y1, x2, y2,
                   x1 AS text_x, greatest(y1 - 25, 5) AS text_y, x1 + 200 AS back_x2, greatest(y1 - 25, 5) + 20 AS back_y2, {_COLOR}
            FROM drawn""",
        "drawn",
    ),
    "embedding_counters": _sql(
        """SELECT count(*) FILTER (status = 'saved' AND face_id NOT IN (SELECT face_id FROM fx_done)) AS saved,
                  count(*) FILTER (face_id IN (SELECT face_id FROM fx_done)) AS skipped,
                  count(*) FILTER (status = 'error' AND face_id NOT IN (SELECT face_id FROM fx_done)) AS errors
           FROM embedded""",
        "embedded",
        "fx_done",
    ),
    "detection_summary": _sql(
        """SELECT frames, faces, round(faces / frames, 2) AS faces_per_frame
           FROM (SELECT count(*) AS frames FROM fx_listed), (SELECT count(*) AS faces FROM lineitem)""",
        "fx_listed",
    ),
    "assign_face_ids": _sql(f"SELECT face_id, image_path, {_BOX}, round(confidence, 6) AS confidence FROM fx_detections", "fx_detections"),
    "top5_preview": _sql(
        "SELECT rank, round(score, 6) AS similarity_score, image_path AS frame_image_path, actor_name FROM matches WHERE rank <= 5", "matches"
    ),
    "matches_union": _sql(f"SELECT {_MATCH} FROM matches", "matches"),
    "detect_with_stub": _sql(f"SELECT movie, image_path, det_no, {_BOX}, round(confidence, 6) AS confidence FROM found", "found"),
    "embed_with_stub": _sql("SELECT movie, face_id, image_path, model, status, error, frame, width, height FROM embedded", "embedded"),
    "render_status": _sql("SELECT frame_image_path, save_path, status, error, faces_drawn, width, height, channels FROM rendered", "rendered"),
    "annotation_counters": _sql(
        """SELECT count(*) FILTER (status = 'processed') AS processed, count(*) FILTER (status = 'skipped') AS skipped,
                  count(*) FILTER (status = 'error') AS errors, CAST(sum(faces_drawn) AS BIGINT) AS faces_drawn
           FROM rendered""",
        "rendered",
    ),
    "tag_run": _sql(
        """SELECT movie, regexp_extract(image_path, '/(shot_.*)$', 1) AS save_path,
                  printf('%s (%.3f)', coalesce(display_name, actor_name), score) AS label, coalesce(text_color, 'black') AS text_color,
                  CAST(actor_ord AS BIGINT) AS actor_ord, rank, face_id, CAST(x1 AS BIGINT) AS x1, CAST(y1 AS BIGINT) AS y1,
                  CAST(x2 AS BIGINT) AS x2, CAST(y2 AS BIGINT) AS y2, CAST(greatest(y1 - 25, 5) AS BIGINT) AS text_y
           FROM wave_matches WHERE rank <= 10""",
        "wave_matches",
    ),
    "matches_all_movies": _sql(f"SELECT movie, {_MATCH} FROM movie_matches", "movie_matches"),
    "movie_status": _sql(
        """SELECT b.movie, coalesce(f.frames, 0) AS frames, coalesce(m.matches, 0) AS matches,
                  CASE WHEN f.frames IS NULL THEN 'skipped' WHEN b.movie = 'movie_1' THEN 'failed' ELSE 'success' END AS status
           FROM (SELECT DISTINCT concat('movie_', CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INT)) AS movie FROM part) b
           LEFT JOIN (SELECT movie, count(*) AS frames FROM fx_listed GROUP BY movie) f ON f.movie = b.movie
           LEFT JOIN (SELECT movie, count(*) AS matches FROM wave_matches WHERE rank <= 10 AND movie <> 'movie_1' GROUP BY movie) m
             ON m.movie = b.movie""",
        "fx_listed",
        "wave_matches",
    ),
    "configured_movies": _sql(
        """SELECT f.movie, coalesce(m.matches, 0) AS matches, CASE WHEN f.movie = 'movie_1' THEN 'failed' ELSE 'success' END AS status,
                  coalesce(m.drawn, 0) AS drawn
           FROM (SELECT DISTINCT movie FROM fx_frames) f
           LEFT JOIN (SELECT movie, count(*) AS matches, count(*) FILTER (WHERE movie <> 'movie_2' OR score >= 0.1) AS drawn
                      FROM wave_matches WHERE movie <> 'movie_1' AND rank <= CAST(movie[7:] AS INT) + 3 GROUP BY movie) m ON m.movie = f.movie""",
        "fx_frames",
        "wave_matches",
    ),
    "lasting_face_ids": _sql(
        f"""SELECT CAST(row_number() OVER (ORDER BY delivery, image_path, det_no) - 1 AS BIGINT) AS face_id, movie, image_path, det_no, {_BOX},
                   round(confidence, 6) AS confidence
            FROM found""",
        "found",
    ),
    "frames_by_run": _sql(
        """SELECT CAST(delivery AS BIGINT) AS batch, movie, count(*) AS frames, count(*) FILTER (frame % 3 = 0) AS without_faces,
                  CAST(sum(frame % 3) AS BIGINT) AS faces
           FROM fx_listed GROUP BY delivery, movie""",
        "fx_listed",
    ),
    "second_run_counts": _sql(
        """SELECT movie, count(*) AS faces, count(*) AS ids, any_value(saved) AS saved, any_value(skipped) AS skipped, any_value(errors) AS errors
           FROM found, (SELECT count(*) FILTER (delivery = 1 AND frame % 97 <> 5) AS saved, count(*) FILTER (delivery = 0 AND frame % 97 <> 5) AS skipped,
                               count(*) FILTER (frame % 97 = 5) AS errors FROM found)
           WHERE frame % 97 <> 5 GROUP BY movie""",
        "found",
    ),
    "published_images": _sql(
        """SELECT frame_image_path, save_path, status, error, faces_drawn, width, height, channels,
                  CASE WHEN status = 'processed' THEN CAST(720 AS BIGINT) END AS file_bytes
           FROM rendered""",
        "rendered",
    ),
    "sample_images": _sql("SELECT image_path AS filepath, count(*) AS boxes FROM samples GROUP BY image_path", "samples"),
    "matches_with_odd_vectors": _sql(
        f"""SELECT {_MATCH} FROM (
              SELECT * REPLACE (row_number() OVER (PARTITION BY actor_ord ORDER BY score DESC, face_id) AS rank)
              FROM matches WHERE face_id % 7 NOT IN (1, 2, 3, 4))
            WHERE rank <= 20""",
        "matches",
    ),
    "matches_with_repeated_ordinals": _sql(
        f"SELECT coalesce(display_name, actor_name) AS display_name, {_MATCH} FROM matches WHERE rank <= 20", "matches"
    ),
    "annotation_of_odd_boxes": _sql(
        """SELECT frame_image_path, face_id, label, CAST(actor_ord AS BIGINT) AS actor_ord, rank, x1, x2
           FROM drawn WHERE face_id % 5 NOT IN (1, 2, 3)""",
        "drawn",
    ),
    "pending_embeddings_without_movie": _sql(
        """SELECT CASE WHEN face_id % 2 = 0 THEN movie END AS movie, face_id, image_path
           FROM fx_detections WHERE face_id NOT IN (SELECT vec_id FROM embeddings)""",
        "fx_detections",
    ),
}
