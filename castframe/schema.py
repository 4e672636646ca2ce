"""Table schemas and fixed values.

Every stage reads and writes tables with an explicit schema; nothing is
inferred from the data.
"""

from __future__ import annotations

from pyspark.sql import types as T

# They decide results and must stay as they are.
IMAGE_SUFFIXES = ("jpg", "png", "jpeg")  # matched case-sensitively
MAX_IMAGE_BYTES = 50 * 1024 * 1024  # larger images are not annotated
NORM_GUARD = 1e-8  # added to a norm before dividing by it
DEFAULT_COLOR = (255, 255, 0)
DEFAULT_TEXT_COLOR = "black"
BOX_WIDTH = 3
FONT_SIZE = 16
LABEL_FORMAT = "%s (%.3f)"
LABEL_RAISE = 25  # a label starts this many pixels above its box ...
LABEL_TOP = 5  # ... but never above this row
LABEL_WIDTH, LABEL_HEIGHT = 200, 20  # background box when text is not measured
DETECTION_BATCH = 64
EMBEDDING_BATCH = 32
SIMILARITY_THRESHOLD = 0.0  # 0.0 switches the filter off
PREVIEW_ROWS = 5

BOX = T.StructType([T.StructField(c, T.DoubleType()) for c in ("x1", "y1", "x2", "y2")])
COLOR = T.StructType([T.StructField(c, T.IntegerType()) for c in ("r", "g", "b")])

FRAMES = T.StructType(
    [
        T.StructField("movie", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
    ]
)

DETECTIONS = T.StructType(
    [
        T.StructField("movie", T.StringType()),
        T.StructField("image_path", T.StringType()),
        T.StructField("det_no", T.LongType()),
        *BOX.fields,
        T.StructField("confidence", T.DoubleType()),
    ]
)

# The column layout of a detections CSV file.
DETECTIONS_CSV = T.StructType(
    [
        T.StructField("image_path", T.StringType()),
        *BOX.fields,
        T.StructField("confidence", T.DoubleType()),
    ]
)

FACE_EMBEDDINGS = T.StructType(
    [
        T.StructField("movie", T.StringType()),
        T.StructField("face_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("model", T.StringType()),
        T.StructField("bbox", BOX),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("image_path", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

GALLERY = T.StructType(
    [
        T.StructField("movie", T.StringType()),
        T.StructField("actor_ord", T.IntegerType()),
        T.StructField("embedding_path", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
    ]
)

MATCHES = T.StructType(
    [
        T.StructField("rank", T.LongType()),
        T.StructField("similarity_score", T.DoubleType()),
        T.StructField("frame_image_path", T.StringType()),
        T.StructField("face_x1", T.DoubleType()),
        T.StructField("face_y1", T.DoubleType()),
        T.StructField("face_x2", T.DoubleType()),
        T.StructField("face_y2", T.DoubleType()),
        T.StructField("face_confidence", T.DoubleType()),
        T.StructField("face_id", T.LongType()),
        T.StructField("actor_name", T.StringType()),
        T.StructField("actor_embedding_path", T.StringType()),
    ]
)

ANNOTATION_PLAN = T.StructType(
    [
        T.StructField("movie", T.StringType()),
        T.StructField("frame_image_path", T.StringType()),
        T.StructField("save_path", T.StringType()),
        T.StructField("actor_ord", T.IntegerType()),
        T.StructField("rank", T.LongType()),
        T.StructField("face_id", T.LongType()),
        *[T.StructField(c, T.IntegerType()) for c in ("x1", "y1", "x2", "y2")],
        T.StructField("label", T.StringType()),
        *[T.StructField(c, T.IntegerType()) for c in ("text_x", "text_y", "back_x2", "back_y2")],
        T.StructField("color", COLOR),
        T.StructField("text_color", T.StringType()),
    ]
)

# Frames that a detector has seen. A frame without faces has a row too.
FRAME_LEDGER = T.StructType(
    [
        *FRAMES.fields,
        T.StructField("detector", T.StringType()),
        T.StructField("faces", T.LongType()),
    ]
)

# The frames that a run is about, and the batches that have seen them.
CURRENT_FRAMES = T.StructType([*FRAMES.fields[:2], T.StructField("batch", T.LongType())])

# Frames that the detector failed on.
DETECTION_ERRORS = T.StructType(
    [T.StructField("movie", T.StringType()), T.StructField("image_path", T.StringType()), T.StructField("error", T.StringType())]
)

# Movies that a stage could not take.
SEARCH_ERRORS = T.StructType([T.StructField("movie", T.StringType()), T.StructField("error", T.StringType())])

RENDERED = T.StructType(
    [
        T.StructField("frame_image_path", T.StringType()),
        T.StructField("save_path", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("faces_drawn", T.LongType()),
        T.StructField("error", T.StringType()),
        *[T.StructField(c, T.IntegerType()) for c in ("height", "width", "channels")],
        T.StructField("pixels", T.BinaryType()),
    ]
)

# Under which conditions each movie was searched, and up to which batch of embeddings.
SEARCH_STATE = T.StructType(
    [
        T.StructField("movie", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("top_k", T.IntegerType()),
        T.StructField("gallery", T.LongType()),
        T.StructField("batch", T.LongType()),
    ]
)

# Partial summaries of the matches of one movie.
SUMMARY_STATES = T.StructType(
    [
        T.StructField("movie", T.StringType()),
        T.StructField("actor_name", T.StringType()),
        T.StructField("count", T.LongType()),
        *[T.StructField(c, T.DoubleType()) for c in ("sum", "max", "min")],
        T.StructField("images", T.BinaryType()),
    ]
)

# The tables between the stages of a run.
STAGES = {
    "detections": T.StructType([*DETECTIONS.fields, T.StructField("face_id", T.LongType())]),
    "current_frames": CURRENT_FRAMES,
    "detection_errors": DETECTION_ERRORS,
    "embeddings": T.StructType([*FACE_EMBEDDINGS.fields, T.StructField("batch", T.LongType())]),
    "embedding_errors": SEARCH_ERRORS,
    "search_errors": SEARCH_ERRORS,
    "search_state": SEARCH_STATE,
    "matches": T.StructType(
        [T.StructField("movie", T.StringType()), T.StructField("actor_ord", T.IntegerType()), *MATCHES.fields]
    ),
    "annotation_plan": ANNOTATION_PLAN,
    "annotated_images": T.StructType([f for f in RENDERED.fields if f.name != "pixels"]),
}

# One JSON object per movie.
CONFIG = T.StructType(
    [
        T.StructField("movie", T.StringType()),
        T.StructField("frames_dir", T.StringType()),
        T.StructField("output_dir", T.StringType()),
        T.StructField("actor_embeddings", T.ArrayType(T.StringType())),
        T.StructField("actor_names", T.MapType(T.StringType(), T.StringType())),
        T.StructField("actor_colors", T.MapType(T.StringType(), COLOR)),
        T.StructField("actor_text_colors", T.MapType(T.StringType(), T.StringType())),
        T.StructField("embedding_model", T.StringType()),
        T.StructField("top_k", T.IntegerType()),
        T.StructField("similarity_threshold", T.DoubleType()),
        T.StructField("face_detection_batch_size", T.IntegerType()),
        T.StructField("embedding_batch_size", T.IntegerType()),
        T.StructField("skip_face_detection", T.BooleanType()),
        T.StructField("skip_embedding_generation", T.BooleanType()),
        T.StructField("skip_actor_search", T.BooleanType()),
        T.StructField("skip_image_generation", T.BooleanType()),
    ]
)

# The struct that Spark's own "image" source produces; data is BGR, row by row.
IMAGE = T.StructType(
    [
        T.StructField("origin", T.StringType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("nChannels", T.IntegerType()),
        T.StructField("mode", T.IntegerType()),
        T.StructField("data", T.BinaryType()),
    ]
)
