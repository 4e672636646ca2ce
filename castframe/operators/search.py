"""Matching faces against a gallery of reference vectors.

The gallery is small: a few vectors per movie. Its size is measured first. It
then travels to the tasks in blocks of bounded size, each as one matrix, and
every task scores its faces with a matrix product. Faces are never shuffled to
be scored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from castframe.functions.boxes import unpack_box
from castframe.functions.paths import stem
from castframe.functions.vectors import cosine_matrix, stack, unit_rows
from castframe.operators.numbering import number_rows
from castframe.schema import MATCHES
from castframe.session import materialize

MAX_BLOCK_BYTES = 64 << 20  # of gallery data sent to the tasks at once
MAX_RANK_ROWS = 1_000_000  # rows of one actor that the salts of a top k let meet in one task
MAX_KEPT_ROWS = 500_000  # best rows that a task holds before it passes them on
MAX_LIST = 2_000  # actors in the score list of one face
_CELLS = 4_000_000  # scores computed at once in a task
_BELOW_ALL = -2.0  # under every cosine

SCORES = T.ArrayType(
    T.StructType([T.StructField("actor_key", T.LongType()), T.StructField("similarity_score", T.DoubleType())])
)


class Block(NamedTuple):
    """Gallery vectors of bounded size: actor keys and one unit-row matrix per movie, and how many matches a movie keeps."""

    matrices: dict[str | None, tuple[np.ndarray, np.ndarray]]
    limits: dict[str | None, int | None]


class Pass(NamedTuple):
    """One block and the faces that can meet it."""

    block: Block
    faces: DataFrame


def keyed_gallery(gallery: DataFrame, within: str | None = None, k: int | str | None = None) -> DataFrame:
    """One row per actor, with ``actor_key``: an actor is a gallery file, of its movie if ``within``.

    A file that several rows name is one actor, with the least movie and ordinal.
    ``_limit`` is ``k``, or what the column of that name says.
    """
    shared = [within] if within else []
    row = F.struct(*[c for c in ("movie", "actor_ord") if c in gallery.columns], "embedding")
    limit = F.max(F.col(k) if isinstance(k, str) else F.lit(k)).cast("int").alias("_limit")
    named = gallery.groupBy(*shared, "embedding_path").agg(F.min(row).alias("row"), limit)
    return named.select(
        *shared, "embedding_path", "row.actor_ord", "row.embedding", "_limit", F.xxhash64(*shared, "embedding_path").alias("actor_key")
    )


def gallery_passes(
    faces: DataFrame, actors: DataFrame, within: str | None, max_bytes: int, max_list: int | None = None
) -> Iterator[Pass]:
    """Fetch the keyed gallery in blocks of bounded size, with the faces to score.

    A block has at most ``max_bytes``; with ``max_list`` no face meets many more
    than that many of its actors. Almost every gallery is one block, so there is
    one pass over the faces. A larger one takes a pass per block. If faces meet
    only the actors of their movie, the blocks hold whole movies and a pass takes
    the faces of those movies alone: on a table stored by movie the passes
    together read every face once.
    """
    shared = [within] if within else []
    length = F.size("embedding")
    size = (
        actors.groupBy(*shared)
        .agg(F.count("*").alias("n"), F.min(length).alias("low"), F.max(length).alias("high"), F.count_distinct("actor_key").alias("keys"))
        .agg(
            F.sum("n").alias("n"), F.max("n").alias("longest"), F.max("high").alias("high"), F.min("low").alias("low"),
            F.bool_or(F.col("low") != F.col("high")).alias("mixed"), F.bool_or(F.col("keys") < F.col("n")).alias("clash"),
        )
        .first()
    )
    if not size["n"]:
        return
    if size["mixed"] or size["low"] < 1:
        raise ValueError("gallery vectors that meet the same faces differ in length or are empty")
    if size["clash"]:
        raise ValueError("two gallery files have the same hash")
    limit = max(1, max_bytes // (8 * size["high"] + 64))
    # Half of the limit on average, so that uneven hashing mostly stays under it.
    pieces = 1 if size["n"] <= limit else math.ceil(2 * size["n"] / limit)
    by_movie = within is not None and size["longest"] <= limit
    if max_list is not None and size["longest"] > max_list:
        by_movie = False
        pieces = max(pieces, math.ceil(2 * size["longest"] / max_list))

    movie = F.col(within) if within else F.lit(None).cast("string").alias("movie")
    for piece in range(pieces):
        part, some = actors, faces
        if pieces > 1 and by_movie:
            here = F.pmod(F.xxhash64(within), F.lit(pieces)) == piece
            part, some = actors.where(here), faces.where(here)
        elif pieces > 1:
            part = actors.where(F.pmod("actor_key", F.lit(pieces)) == piece)
        fetched = part.select(movie, "actor_key", "embedding", "_limit").toArrow()
        fetched = fetched.sort_by([(fetched.column_names[0], "ascending"), ("actor_key", "ascending")])
        for at in range(0, fetched.num_rows, limit):
            yield Pass(_block(fetched.slice(at, limit)), some)


def _block(table: pa.Table) -> Block:
    """A block from gallery rows that are sorted by movie."""
    keys = table.column("actor_key").to_numpy()
    vectors = table.column("embedding").combine_chunks()
    known = table.column("_limit").to_pylist()
    matrices, limits, begin = {}, {}, 0
    for movie, rows in groupby(table.column(0).to_pylist()):
        end = begin + sum(1 for _ in rows)
        own = vectors.slice(begin, end - begin)
        matrices[movie] = (keys[begin:end], unit_rows(stack(own, len(own[0]))))
        limits[movie] = known[begin]
        begin = end
    return Block(matrices, limits)


def _scored_parts(block: Block, vectors: pa.Array, movies: pa.Array | None) -> Iterator[tuple]:
    """Yield (row numbers, movie, ordinals, scores) for the rows of one batch."""
    for rows, movie, matrix in _rows_by_movie(block, vectors, movies):
        ords, units = block.matrices[movie]
        yield rows, movie, ords, cosine_matrix(matrix, units)


def _rows_by_movie(block: Block, vectors: pa.Array, movies: pa.Array | None) -> Iterator[tuple]:
    """Yield (row numbers, movie, their vectors), few enough to score at once.

    Rows without a vector, and vectors that are not finite, meet no actor.
    """
    lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    if movies is None:
        rows_of = {None: np.flatnonzero(lengths)}
    else:
        coded = movies.dictionary_encode()
        codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        names = coded.dictionary.to_pylist()
        rows_of = {name: np.flatnonzero((codes == code) & (lengths > 0)) for code, name in enumerate(names)}
    for movie, rows in rows_of.items():
        if movie not in block.matrices or not len(rows):
            continue
        keys, units = block.matrices[movie]
        own = vectors if len(rows) == len(vectors) else vectors.take(pa.array(rows))
        matrix = stack(own, units.shape[1])
        finite = np.isfinite(matrix).all(axis=1)
        if not finite.all():
            rows, matrix = rows[finite], matrix[finite]
        step = max(1, _CELLS // len(keys))
        for at in range(0, len(rows), step):
            yield rows[at : at + step], movie, matrix[at : at + step]


def _score_lists(block, within: bool):
    """Arrow function: for each face, its score against every actor of its movie."""

    def lists(vectors: pa.Array, movies: pa.Array | None) -> pa.Array:
        n = len(vectors)
        sizes = np.zeros(n, dtype=np.int64)
        parts = list(_scored_parts(block.value, vectors, movies))
        for rows, _, ords, _ in parts:
            sizes[rows] = len(ords)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        actor = np.empty(offsets[-1], dtype=np.int64)
        score = np.empty(offsets[-1], dtype=np.float64)
        for rows, _, ords, scores in parts:
            cells = offsets[rows][:, None] + np.arange(len(ords))[None, :]
            actor[cells] = ords[None, :]
            score[cells] = scores
        values = pa.StructArray.from_arrays([pa.array(actor), pa.array(score)], names=["actor_key", "similarity_score"])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)

    if within:

        @F.arrow_udf(SCORES)
        def of_movie(vectors: pa.Array, movies: pa.Array) -> pa.Array:
            return lists(vectors, movies)

        return of_movie

    @F.arrow_udf(SCORES)
    def of_all(vectors: pa.Array) -> pa.Array:
        return lists(vectors, None)

    return of_all


def _all_scores(faces: DataFrame, passes: Iterator[Pass], within: str | None) -> DataFrame:
    rest = [c for c in faces.columns if c != "embedding"]
    results = []
    for one in passes:
        function = _score_lists(faces.sparkSession.sparkContext.broadcast(one.block), bool(within))
        lists = function(F.col("embedding"), F.col(within)) if within else function(F.col("embedding"))
        results.append(one.faces.select(*rest, F.inline(lists)))
    return reduce(DataFrame.unionByName, results or [_no_scores(faces)])


def _no_scores(faces: DataFrame) -> DataFrame:
    rest = [c for c in faces.columns if c != "embedding"]
    return faces.select(*rest, F.lit(0).cast("long").alias("actor_key"), F.lit(0.0).alias("similarity_score")).where(F.lit(False))


def score_all(faces: DataFrame, gallery: DataFrame, within: str | None = None, max_bytes: int = MAX_BLOCK_BYTES) -> DataFrame:
    """Every face with its score against every actor (of its movie, if ``within``), by ordinal.

    Only the vectors pass through Python; the other columns stay in the JVM.
    Faces without a vector, or with one that is not finite, have no score.
    """
    shared = [within] if within else []
    actors = keyed_gallery(gallery, within)
    scored = _all_scores(faces, gallery_passes(faces, actors, within, max_bytes, max_list=MAX_LIST), within)
    ordinals = actors.select(*shared, "actor_key", "actor_ord")
    return scored.join(ordinals, [*shared, "actor_key"]).select(*[c for c in faces.columns if c != "embedding"], "actor_ord", "similarity_score")


def _first_k(ords: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best entries of each actor: falling score, then id."""
    order = np.lexsort((ids, -scores, ords))
    ords = ords[order]
    begins = np.flatnonzero(np.concatenate([[True], ords[1:] != ords[:-1]]))
    place = np.arange(len(ords)) - np.repeat(begins, np.diff(np.concatenate([begins, [len(ords)]])))
    return order[place < k]


class _Best:
    """The k best rows per actor of one movie that a task has seen so far."""

    def __init__(self, actors: np.ndarray, k: int):
        self.k = k
        self.actors = actors  # ascending
        self.bar = np.full(len(actors), _BELOW_ALL)  # k-th best score per actor
        self.columns = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)  # actor, score, id
        self.rows: pa.Table | None = None

    def __len__(self) -> int:
        return len(self.columns[0])

    def add(self, batch: pa.Table, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        i, j = np.nonzero(scores >= self.bar[None, :])
        if not len(i):
            return
        held = len(self.columns[0])
        pooled = [np.concatenate(pair) for pair in zip(self.columns, (j, scores[i, j], ids[rows[i]]))]
        keep = np.sort(_first_k(pooled[0], pooled[1], pooled[2], self.k))
        self.columns = tuple(values[keep] for values in pooled)
        # Only the rows that stay are copied: first old ones, then new ones.
        fresh = batch.take(pa.array(rows[i[keep[keep >= held] - held]]))
        if self.rows is not None:
            fresh = pa.concat_tables([self.rows.take(pa.array(keep[keep < held])), fresh])
        self.rows = fresh.combine_chunks()
        full = np.bincount(self.columns[0], minlength=len(self.bar)) >= self.k
        lowest = np.full(len(self.bar), np.inf)
        np.minimum.at(lowest, self.columns[0], self.columns[1])
        self.bar = np.maximum(self.bar, np.where(full, lowest, _BELOW_ALL))

    def passed_on(self) -> pa.Table:
        """The rows held so far. Their bars stay: k rows at least are known to reach them."""
        actor, score, _ = self.columns
        table = self.rows.append_column("actor_key", pa.array(self.actors[actor], pa.int64())).append_column(
            "similarity_score", pa.array(score, pa.float64())
        )
        self.columns = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
        self.rows = None
        return table


def _best_scores(faces: DataFrame, passes: Iterator[Pass], within: str | None) -> DataFrame:
    """The k best faces per actor within each task, or a few more: all that can still reach the top k."""
    rest = [c for c in faces.columns if c != "embedding"]
    schema = T.StructType([faces.schema[c] for c in rest] + SCORES.elementType.fields)
    limit = MAX_KEPT_ROWS
    results = []
    for one in passes:
        shared = faces.sparkSession.sparkContext.broadcast(one.block)

        def best(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            kept: dict[str | None, _Best] = {}
            for batch in batches:
                table = pa.Table.from_batches([batch])
                ids = table.column("face_id").to_numpy()
                movies = batch.column(within) if within else None
                plain = table.select(rest)
                for rows, movie, keys, scores in _scored_parts(shared.value, batch.column("embedding"), movies):
                    if movie not in kept:
                        kept[movie] = _Best(keys, shared.value.limits[movie])
                    kept[movie].add(plain, rows, ids, scores)
                if sum(map(len, kept.values())) > limit:
                    for found in kept.values():
                        if found.rows is not None:
                            yield from found.passed_on().to_batches()
            for found in kept.values():
                if found.rows is not None:
                    yield from found.passed_on().to_batches()

        results.append(one.faces.select(*rest, "embedding").mapInArrow(best, schema))
    return reduce(DataFrame.unionByName, results or [_no_scores(faces)])


def match_faces(
    faces: DataFrame,
    gallery: DataFrame,
    k: int | str | None = None,
    within: str | None = None,
    max_bytes: int = MAX_BLOCK_BYTES,
) -> DataFrame:
    """Rank the faces against every actor by cosine similarity, best first.

    ``faces`` has face_id, embedding, image_path, bbox and confidence;
    ``gallery`` has actor_ord, embedding_path and embedding. An actor is a gallery
    file: ordinals may repeat between movies. ``k`` limits the matches per actor,
    None keeps them all; ranks are the same either way. With ``within`` it may also
    name a column of the gallery that holds it for each movie: movies with a limit
    take one search and those without another, however many limits there are. ``within`` names a column
    that both sides share, such as ``movie``: faces then meet only the actors of
    their own movie. Equal scores rank by face id. Faces without a vector, or with
    one that is not finite, match nobody. The result has the match columns, plus
    ``actor_ord`` and the ``within`` column.

    All pairs are scored, written and sorted at once, when this is called: callers
    that need no rank take ``score_all``.
    """
    if isinstance(k, str):
        return _match_by_movie(faces, gallery, k, within, max_bytes)
    if k is not None and k < 1:
        raise ValueError("k must be positive")
    shared = [within] if within else []
    actors = keyed_gallery(gallery, within, k)
    groups = [*shared, "actor_key"]
    order = [F.desc("similarity_score"), F.asc("face_id")]
    faces = faces.select(*shared, "face_id", "image_path", "bbox", "confidence", "embedding")
    if k is not None:
        scored = _best_scores(faces, gallery_passes(faces, actors, within, max_bytes), within)
        ranked = _rank_best(scored, groups, order, k).where(F.col("rank") <= k)
    else:
        # The sort samples its input first; scoring must not run twice for it.
        scored = _all_scores(faces, gallery_passes(faces, actors, within, max_bytes, max_list=MAX_LIST), within)
        ranked = number_rows(materialize(scored, "scored"), order, "rank", groups)
    return _as_matches(ranked, actors, shared)


def _match_by_movie(faces: DataFrame, gallery: DataFrame, k: str, within: str | None, max_bytes: int) -> DataFrame:
    """``match_faces`` with the limit of each movie in column ``k`` of the gallery; null keeps all."""
    if within is None:
        raise ValueError("limits by movie need within")
    limits = materialize(gallery.groupBy(within).agg(F.max(k).cast("int").alias("_limit")), "limits")
    found = limits.agg(F.count("_limit").alias("limited"), F.count("*").alias("movies"), F.max("_limit").alias("most"), F.min("_limit").alias("least")).first()
    if found["limited"] and found["least"] < 1:
        raise ValueError("k must be positive")
    parts = []
    if found["limited"]:
        faces_in = faces.select(within, "face_id", "image_path", "bbox", "confidence", "embedding")
        limited = gallery.drop(k).join(limits.where("_limit is not null").withColumnRenamed("_limit", k), within)
        actors = keyed_gallery(limited, within, k)
        scored = _best_scores(faces_in, gallery_passes(faces_in, actors, within, max_bytes), within)
        ranked = _rank_best(scored, [within, "actor_key"], [F.desc("similarity_score"), F.asc("face_id")], found["most"])
        own = ranked.join(limits, within).where(F.col("rank") <= F.col("_limit")).drop("_limit")
        parts.append(_as_matches(own, actors, [within]))
    if found["movies"] > found["limited"]:
        unlimited = gallery.join(limits.where("_limit is null").select(within), within, "left_semi")
        parts.append(match_faces(faces, unlimited, None, within, max_bytes))
    return reduce(DataFrame.unionByName, parts or [match_faces(faces, gallery, 1, within, max_bytes)])


def _rank(scored: DataFrame, groups: list[str], order: list) -> DataFrame:
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy(*groups).orderBy(*order)))


def _rank_best(scored: DataFrame, groups: list[str], order: list, k: int) -> DataFrame:
    """Reduce the tasks' best rows in two steps, so that no step gets them all.

    Every task contributes up to k rows per actor, or a few more. Salts keep the
    number of rows that meet in one task under ``MAX_RANK_ROWS`` in the second
    step, or at k where that is more.
    """
    partitions = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = max(1, min(partitions, MAX_RANK_ROWS // k))
    salted = scored.withColumn("_salt", F.pmod(F.xxhash64("face_id"), F.lit(salts)))
    first = _rank(salted, [*groups, "_salt"], order).where(F.col("rank") <= k)
    return _rank(first.drop("rank", "_salt"), groups, order)


def _as_matches(ranked: DataFrame, actors: DataFrame, shared: list[str]) -> DataFrame:
    """Ranked rows with the names of their actors. Catalyst broadcasts these if their size permits."""
    path = F.col("embedding_path")
    named = actors.select(*shared, "actor_key", "actor_ord", stem(path).alias("actor_name"), path.alias("actor_embedding_path"))
    return ranked.join(named, [*shared, "actor_key"]).select(
        *shared,
        "actor_ord",
        F.col("rank").cast("bigint").alias("rank"),
        "similarity_score",
        F.col("image_path").alias("frame_image_path"),
        *unpack_box("bbox"),
        F.col("confidence").alias("face_confidence"),
        "face_id",
        "actor_name",
        "actor_embedding_path",
    )


def merge_matches(stored: DataFrame, fresh: DataFrame, k: int | str, within: str | None = None) -> DataFrame:
    """The best ``k`` of each actor, from its stored best ``k`` and the best ``k`` of faces that came later.

    The result is that of a search over all faces, of which only the later ones were
    read. ``k`` is a number or names a column of both sides. A face in both counts once.
    """
    actor = [*([within] if within else []), "actor_embedding_path"]
    both = stored.unionByName(fresh).dropDuplicates([*actor, "face_id"])
    best = Window.partitionBy(*actor).orderBy(F.desc("similarity_score"), F.asc("face_id"))
    ranked = both.withColumn("rank", F.row_number().over(best).cast("bigint"))
    return ranked.where(F.col("rank") <= (F.col(k) if isinstance(k, str) else F.lit(k))).select(*stored.columns)


def preview(matches: DataFrame, rows: int) -> DataFrame:
    """The best few matches of each actor. Ranks are dense, so a filter does it."""
    return matches.where(F.col("rank") <= rows).select("rank", "similarity_score", "frame_image_path", "actor_name")


def union_matches(*runs: DataFrame) -> DataFrame:
    """One match table from separate runs."""
    return reduce(DataFrame.unionByName, runs).select(*MATCHES.fieldNames())
