"""Tables that grow by numbered batches, and the ledger of processed frames."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from castframe.functions.boxes import CORNERS
from castframe.operators.numbering import extend_ids
from castframe.schema import FRAME_LEDGER, STAGES
from castframe.session import materialize

_BATCH = T.StructField("batch", T.LongType())
FRAME = ("movie", "path", "length", "detector")  # a file that changed its length is another frame


class BatchedTable:
    """A folder with one folder per batch. A batch counts once its commit marker is there; writing one again replaces it."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema

    def numbers(self) -> list[int]:
        """The finished batches. One listing of folders; no data is read."""
        pattern = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch=*/_SUCCESS")
        found = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
        return sorted(int(re.search(r"/batch=(\d+)/_SUCCESS$", s.getPath().toString())[1]) for s in found)

    def write(self, rows: DataFrame, number: int) -> None:
        rows.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(f"{self.path}/batch={number}")

    def read(self, numbers: list[int]) -> DataFrame:
        """The rows of these batches, with the ``batch`` they are of."""
        whole = T.StructType([*self.schema.fields, _BATCH])
        if not numbers:
            return self.spark.createDataFrame([], whole)
        folders = [f"{self.path}/batch={n}" for n in numbers]
        return self.spark.read.schema(whole).option("basePath", self.path).parquet(*folders)


class DetectionLedger:
    """Which frames a detector has seen, those without faces too, and the faces it found.

    Both tables are appended to. A batch's faces are written first and its frames
    last: the frames commit it, so the faces of a run that broke off are never read
    and its number is written over. Face ids last: no later batch changes them.
    """

    def __init__(self, spark: SparkSession, folder: str):
        folder = folder.rstrip("/")
        self.spark = spark
        self.frames = BatchedTable(spark, f"{folder}/frame_ledger", FRAME_LEDGER)
        self.faces = BatchedTable(spark, f"{folder}/detections", STAGES["detections"])

    def seen(self) -> DataFrame:
        return self.frames.read(self.frames.numbers())

    def compared(self, listed: DataFrame) -> DataFrame:
        """The distinct frames (movie, path, length, detector) of a listing, with the ``batch`` that has seen them, else null."""
        seen = self.seen().groupBy(*FRAME).agg(F.max("batch").alias("batch"))
        seen = seen.select(*[F.col(c).alias(f"_{c}") for c in FRAME], "batch")
        # The path is the plain key of the join: without a null it is hashed and splits under skew.
        same = (F.col("path") == F.col("_path")) & _equal("movie", "length", "detector")
        return listed.select(*FRAME).distinct().join(seen, same, "left").select(*FRAME, "batch")

    def add(self, frames: DataFrame, found: DataFrame) -> int:
        """Append frames (movie, path, length, detector) and the faces ``found`` in them. Returns the batch.

        A box that an earlier detector found in the same file keeps its id; all other
        faces are numbered from the greatest id on, in the order of path and detection.
        """
        numbers = self.frames.numbers()
        batch = numbers[-1] + 1 if numbers else 0
        stored = self.faces.read(numbers)
        last = stored.agg(F.max("face_id")).first()[0] if numbers else None
        order = [F.col(c) for c in ("image_path", "det_no", *CORNERS, "confidence")]
        known = self._same_files(frames, stored) if numbers else None
        keys = ("movie", "image_path", *CORNERS)
        self.faces.write(extend_ids(found, known, keys, order, "face_id", 0 if last is None else last + 1), batch)
        counts = self.faces.read([batch]).groupBy("movie", F.col("image_path").alias("path")).agg(F.count("*").alias("faces"))
        counts = counts.select(F.col("movie").alias("_movie"), F.col("path").alias("_path"), "faces")
        counted = frames.join(counts, (F.col("path") == F.col("_path")) & _equal("movie"), "left")
        self.frames.write(counted.select(*FRAME, F.coalesce("faces", F.lit(0)).alias("faces")), batch)
        return batch

    def _same_files(self, frames: DataFrame, stored: DataFrame) -> DataFrame | None:
        """The stored faces of files that have the same length now, if there are any."""
        seen = self.seen().select(F.col("movie").alias("_movie"), F.col("path").alias("_path"), F.col("length").alias("_length"), "batch")
        again = materialize(
            frames.join(seen, (F.col("path") == F.col("_path")) & _equal("movie", "length")).select("_movie", "_path", "batch").distinct(), "seen-before"
        )
        if again.isEmpty():
            return None
        faces = stored.withColumnRenamed("batch", "_batch")
        same = (F.col("image_path") == F.col("_path")) & _equal("movie") & (F.col("batch") == F.col("_batch"))
        return faces.join(again, same, "left_semi")

    def current(self, frames: DataFrame) -> DataFrame:
        """The faces of the frames (movie, path, batch) alone. Without frames that went or changed, nothing is joined."""
        numbers = self.frames.numbers()
        faces = self.faces.read(numbers)
        if frames.count() == self.frames.read(numbers).count():
            return faces.drop("batch")
        kept = frames.select(F.col("movie").alias("_movie"), F.col("path").alias("_path"), F.col("batch").alias("_batch"))
        same = (F.col("image_path") == F.col("_path")) & _equal("movie") & (F.col("batch") == F.col("_batch"))
        return faces.join(kept, same, "left_semi").drop("batch")


def _equal(*names: str) -> Column:
    """Each of the columns equals the one of that name after an underscore; missing values are equal."""
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in names]
    return same[0] if len(same) == 1 else same[0] & _equal(*names[1:])
