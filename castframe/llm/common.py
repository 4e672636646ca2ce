"""What several operators share: reading tables, batches of bounded size, components."""

from __future__ import annotations

from collections.abc import Collection, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from castframe.session import materialize

BATCH_BYTES = 8 << 20
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches end by their bytes too, so that many long texts never meet in one."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with about ``limit`` bytes of text, one row at least and ``SLICE_ROWS`` at most."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for at, size in enumerate(sizes):
        if at > start and (held + size > limit or at - start == SLICE_ROWS):
            yield batch.slice(start, at - start)
            start, held = at, 0
        held += size
    if len(sizes) > start:
        yield batch.slice(start)


def packed(df: DataFrame, text_col: str, *fields: T.StructField) -> tuple[DataFrame, T.StructType]:
    """``_text``, and in ``_row`` all columns that ``fields`` do not replace; the schema of ``_row`` and ``fields``."""
    new = {f.name.lower() for f in fields}
    rows = df.select(F.col(text_col).alias("_text"), whole_row(df, new).alias("_row"))
    return rows, T.StructType([rows.schema["_row"], *fields])


def whole_row(df: DataFrame, without: Collection[str] = ()) -> Column:
    """All columns as one struct, so that no name can clash with an operator's own."""
    kept = [c for c in df.columns if c.lower() not in without]
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`").alias(c) for c in kept])


def changed_rows(df: DataFrame, text: Column, same: Column) -> DataFrame:
    """The rows in ``_row`` with ``text`` as their text; n_chars, where there is one, follows unless ``same``."""
    row = df.schema["_row"].dataType
    new = {"text": text}
    if "n_chars" in row.names:
        new["n_chars"] = F.when(same, F.col("_row")["n_chars"]).otherwise(F.length(text).cast("long"))
    return df.select(*[(new[c].cast(row[c].dataType) if c in new else F.col("_row")[c]).alias(c) for c in row.names])


def text_key(doc_id: Column, text: Column) -> Column:
    """Identifies a document row, in the order of ids, nulls last: rows alike in id and text share one key."""
    return F.struct(
        doc_id.isNull().alias("none"),
        doc_id.cast("long").alias("doc_id"),
        F.xxhash64(text.isNull(), F.coalesce(text, F.lit(""))).alias("hash"),
    )


def components(edges: DataFrame, label: str, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (node, root), root the smallest node.

    Alternating large-star and small-star steps, two aggregates and two joins in
    one job a round; no component is gathered, though a task streams the edges of a
    node. Every round is written to the shared folder. Nodes without an edge to
    another node are left out; null ends and loops are ignored; a root is its own
    root. No edges give no rows.
    """
    a, b = F.col("a"), F.col("b")
    now = materialize(
        edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), f"{label}-edges"
    )
    for turn in range(max_rounds):
        if _are_stars(now):
            return now.select(a.alias("node"), b.alias("root")).union(now.select(b.alias("node"), b.alias("root")).distinct())
        both = now.select(a.alias("u"), b.alias("v")).union(now.select(b.alias("u"), a.alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        root = large.groupBy("a").agg(F.min("b").alias("m"))
        m = F.col("m")
        two = F.array(F.struct(b.alias("a"), m.alias("b")), F.struct(a.alias("a"), m.alias("b")))
        small = large.join(root, "a").select(F.explode(two).alias("e")).select("e.a", "e.b").where(a != b)
        now = materialize(small.distinct(), f"{label}-round{turn}")
    raise RuntimeError("the components did not settle")


def _are_stars(edges: DataFrame) -> bool:
    """Whether every larger end has one edge and is no smaller end: then the smaller ends are the roots."""
    ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("root")).union(
        edges.select(F.col("b").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("root"))
    )
    counted = ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("root").alias("root"))
    return counted.where("out > 1 or out > 0 and root > 0").isEmpty()
