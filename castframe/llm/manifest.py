"""A Merkle manifest of a data set, with one inclusion proof per document by pointer jumping.

A document's leaf is the SHA-256 of its fields. The leaves of a language, in the order
of their ids, form a binary tree whose top is the language's subroot; the subroots, in
the order of the languages, form another whose top is the root. Digests are hashed as
lowercase hexadecimal text and stored as 32 bytes.

The levels are built ``STEP`` at a time from aligned runs of nodes, so no level needs a
job of its own and no group has more than ``2 ** STEP`` rows. A node at the bottom of a
run holds the segment of its siblings on the way to the run's top, its ancestor at that
distance. Self-joins double the distance: a node's segment is followed by that of the
node it leads to, until every leaf leads to its subroot and then to the root. After a
doubling only the nodes of every second remaining level are still led to, so the far side
shrinks by its distance; it is broadcast once its proven size is small, and before that
no key is hot. A leaf's own columns travel with it, so nothing is joined back.

Defined cases: a null field is hashed as ``-``, an empty text as ``0:``. Rows alike in
language and id are ordered by their leaves, null ids come first; repeated rows are leaves
of their own, with proofs of their own. The null language is a tree like any other and
comes first. A lone leaf is its subroot, a lone subroot the root. An empty table gives no
rows. Very long texts are hashed where they are read; only digests are shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from castframe.operators.numbering import number_rows
from castframe.session import materialize

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = 8  # levels that are built from one run
BROADCAST_BYTES = 32 << 20

SEGMENT = T.ArrayType(T.StructType([T.StructField("left", T.BinaryType()), T.StructField("right", T.BinaryType())]))


def _nothing() -> Column:
    return F.unhex(F.lit(""))


def leaf_digest(fields: Mapping[str, Column]) -> Column:
    """The leaf of a document, as 32 bytes, of its ``FIELDS``."""
    parts = []
    for name in FIELDS:
        value = fields[name].cast("string")
        parts.append(F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def shown(digest: Column) -> Column:
    """A digest as lowercase hexadecimal text."""
    return F.lower(F.hex(digest))


def _parent(*digests: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[shown(d) for d in digests]), 256))


def _depth(leaves: Column) -> Column:
    """The levels above that many leaves."""
    return F.when(leaves > 1, F.length(F.bin(leaves - 1))).otherwise(0)


def _above(level: Column) -> Column:
    places = F.sequence(F.lit(0), F.shiftright(F.size(level) - 1, 1))
    return F.transform(places, lambda i: _parent(F.get(level, 2 * i), F.coalesce(F.get(level, 2 * i + 1), _nothing())))


def _runs(nodes: DataFrame, base: int, label: str) -> DataFrame:
    """From nodes (tree, depth, idx, digest, own) of level ``base``: each run with the arrays h0, h1, ... of its levels, written."""
    row = F.sort_array(F.collect_list(F.struct("idx", "digest", "own")))
    runs = nodes.groupBy("tree", "depth", F.shiftright("idx", STEP).alias("run")).agg(row.alias("rows"))
    runs = runs.withColumns({"h0": F.transform("rows", lambda x: x["digest"]), "owns": F.transform("rows", lambda x: x["own"])}).drop("rows")
    for k in range(STEP):
        runs = runs.withColumn(f"h{k + 1}", F.when(F.col("depth") > base + k, _above(F.col(f"h{k}"))))
    return materialize(runs, f"{label}-runs{base}")


def _segments(runs: DataFrame, base: int) -> DataFrame:
    """(tree, level, idx, segment, own) of the nodes of level ``base``, with their siblings up to the top of the run."""

    def sibling(k: int, i: Column) -> Column:
        h, at = F.col(f"h{k}"), F.shiftright(i, k)
        left = F.when(at % 2 == 1, F.get(h, at - 1)).otherwise(_nothing())
        right = F.when(at % 2 == 0, F.coalesce(F.get(h, at + 1), _nothing())).otherwise(_nothing())
        return F.struct(left.alias("left"), right.alias("right"))

    def node(own: Column, i: Column) -> Column:
        way = F.slice(F.array(*[sibling(k, i) for k in range(STEP)]), F.lit(1), F.least(F.lit(STEP), F.col("depth") - base))
        return F.struct(F.lit(base).alias("level"), (F.shiftleft("run", STEP) + i).alias("idx"), way.alias("segment"), own.alias("own"))

    return runs.select("tree", F.inline(F.transform("owns", node)))


def _small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df`` to be broadcast if its proven size permits."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def _same_tree() -> Column:
    return F.col("tree").eqNullSafe(F.col("_tree"))


def _jumped(nodes: DataFrame, deepest: int, leaves: int, trees: int, label: str) -> DataFrame:
    """The leaves' rows of ``nodes``, with the segments of their whole way to the top."""
    distance = STEP
    while distance < deepest:
        near = nodes.where(F.col("level") % (2 * distance) == 0)
        far = nodes.where(F.col("level") % (2 * distance) == distance).select(
            F.col("tree").alias("_tree"), F.col("level").alias("_level"), F.col("idx").alias("_idx"), F.col("segment").alias("_segment")
        )
        most = 2 * leaves // 2**distance + trees * deepest  # a level has half as many nodes as the one below it, or one
        to = _same_tree() & (F.col("level") + distance == F.col("_level")) & (F.shiftright("idx", distance) == F.col("_idx"))
        joined = near.join(_small(far, most, 100 + 100 * distance), to, "left")
        segment = F.concat("segment", F.coalesce("_segment", F.array().cast(SEGMENT)))
        nodes = materialize(joined.select("tree", "level", "idx", segment.alias("segment"), "own"), f"{label}-jump{distance}")
        distance *= 2
    return nodes.where("level = 0").drop("level")


def _proved(placed: DataFrame, label: str) -> tuple[DataFrame, int]:
    """(tree, idx, segment, own, top) of the leaves (tree, idx, digest, own), whose places in their trees are dense from 0; how many trees."""
    sizes = materialize(placed.groupBy("tree").agg(F.count("*").alias("n")).withColumn("depth", _depth(F.col("n"))), f"{label}-sizes")
    most = sizes.agg(F.max("depth").alias("deepest"), F.sum("n").alias("leaves"), F.count("*").alias("trees")).first()
    deepest, trees = most["deepest"] or 0, most["trees"]
    of_tree = _small(sizes.select(F.col("tree").alias("_tree"), "depth"), trees, 100)
    level = placed.join(of_tree, _same_tree()).select("tree", "depth", "idx", "digest", "own")
    nodes, tops = [], []
    for base in range(0, max(deepest, 1), STEP):
        runs = _runs(level, base, label)
        nodes.append(_segments(runs, base))
        here = F.element_at(F.array(*[F.get(f"h{k}", F.lit(0)) for k in range(STEP + 1)]), F.col("depth") - base + 1)
        tops.append(runs.where(F.col("depth") <= base + STEP).select(F.col("tree").alias("_tree"), here.alias("top")))
        above = runs.where(F.col("depth") > base + STEP)
        level = above.select("tree", "depth", F.col("run").alias("idx"), F.get(f"h{STEP}", F.lit(0)).alias("digest"), F.lit(None).cast(runs.schema["owns"].dataType.elementType).alias("own"))
    proved = _jumped(reduce(DataFrame.union, nodes), deepest, most["leaves"] or 0, trees, label)
    return proved.join(_small(reduce(DataFrame.union, tops), trees, 100), _same_tree()).drop("_tree"), trees


def manifest(docs: DataFrame, carried: Mapping[str, Column] | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, siblings) for each row of ``docs``, and the ``carried`` expressions over it.

    ``siblings`` has a (left, right) pair per level, from the leaf upwards, either of them
    empty where there is no sibling on that side.
    """
    carried = carried or {}
    leaves = docs.select(
        F.col("lang").cast("string").alias("tree"), F.col("doc_id").alias("doc_id"), leaf_digest({c: F.col(c) for c in FIELDS}).alias("digest"),
        F.struct(F.lit(0).alias("_"), *[e.alias(c) for c, e in carried.items()]).alias("carried"),
    )
    # The sort samples its input first; texts are hashed once.
    leaves = materialize(leaves, "merkle-leaves")
    placed = number_rows(leaves, [F.asc_nulls_first("doc_id"), F.col("digest")], "idx", ["tree"], start=0)
    own = F.struct("doc_id", "digest", "carried").alias("own")
    low, trees = _proved(materialize(placed.select("tree", "idx", "digest", own), "merkle-placed"), "merkle-low")
    low = low.withColumnRenamed("top", "subroot")

    subroots = low.where("idx = 0").select("tree", "subroot")
    ordered = number_rows(subroots, [F.asc_nulls_first("tree")], "idx", start=0)
    high, _ = _proved(ordered.select(F.lit("").alias("tree"), "idx", F.col("subroot").alias("digest"), F.col("tree").alias("own")), "merkle-high")
    # The last jump: from a subroot to the root.
    last = high.select(F.col("own").alias("_tree"), F.col("segment").alias("more"), F.col("top").alias("root"))
    whole = low.join(_small(last, trees, 4_000), _same_tree())
    return whole.select(
        "own.doc_id", F.col("own.digest").alias("leaf"), "subroot", "root", F.concat("segment", "more").alias("siblings"),
        *[F.col("own.carried")[c].alias(c) for c in carried],
    )


def folded(leaf: Column, siblings: Column) -> Column:
    """The root that a leaf and its siblings lead to: equal to the true root if neither was changed."""
    return F.aggregate(siblings, leaf, lambda below, s: _parent(s["left"], below, s["right"]))


def proof_digest(siblings: Column) -> Column:
    """SHA-256 of all siblings in order, as hexadecimal text."""
    return F.sha2(F.array_join(F.transform(siblings, lambda s: F.concat(shown(s["left"]), shown(s["right"]))), ""), 256)
