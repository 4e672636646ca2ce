"""Ranked lexical search with hashed max-sketches.

Each document folds the frequencies of its terms into a sketch: an array of bytes, eight
for each distinct term and a power of two in all, in which a coordinate holds the largest
frequency of the terms that hash to it. A term has two coordinates, and the smaller of
their values is never below its frequency. As a term's score grows with its frequency, a
batch of queries looked up in a sketch gives upper bounds on all their scores.

A query's documents with the highest bounds are scored exactly first. Its k-th best score
is its threshold; the bounds are looked up again, and documents whose bound reaches the
threshold are scored exactly in falling order of their bounds, in growing portions that
raise the threshold, until none is left. So the result is exact, and texts are read again
for the documents alone that could be in it.

One pass over the texts makes the sketches and counts the documents of each query term: a
filter of fixed size takes out most other terms where they stand, and a join the rest.
Queries go to the tasks in blocks of ``BLOCK_TERMS`` terms, or of one query that has more;
each block takes its passes over the sketches, which are smaller than the texts.

Defined cases: a null text, or one without a term, has no terms; it is no result and does
not count as a document. A query without terms, or with none in the documents, has no
rows. Queries alike in id and text are one. Documents alike in id and text are results
each; ids may repeat, and null ids come last among equal scores. Empty tables give no
rows. A task holds the distinct terms of one text at a time, however long it is. Further
columns are not read.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from castframe.llm.common import bounded_batches, text_key
from castframe.session import materialize, ship

SPREAD, LEAST_WIDTH = 8, 64  # coordinates of a sketch for each distinct term; at least
COARSE = (1 << 20) - 1  # the filter on query terms has this many entries and one more
BLOCK_TERMS = 200_000  # query terms sent to the tasks at once
HELD_TERMS = 100_000  # counts that a task holds before it passes them on
FIRST = 20  # times k documents scored first
MORE = 8  # times as many in each later portion
MOST_PART = 1_000_000  # above every term's share of a score
_TURN = np.uint64(0x9E3779B97F4A7C15)  # fixed: makes the second coordinate
_SIGN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

KEY = "key struct<none boolean, doc_id long, hash long>"


class Corpus(NamedTuple):
    """Documents that have terms, and all their terms."""

    documents: int
    terms: int


class Block(NamedTuple):
    """A batch of queries: for each of ``items`` the terms from ``starts`` on, by their place in ``terms``."""

    items: np.ndarray
    starts: np.ndarray
    places: np.ndarray
    weights: np.ndarray  # times the occurrences in the query
    terms: list[bytes]  # distinct
    hashes: np.ndarray


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text, with A-Z in lower case."""
    return (text or b"").translate(_SIGN).split()


def _hashes(terms: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, terms), np.uint32, len(terms))


def _coordinates(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(width - 1)
    wide = hashes.astype(np.uint64)
    return wide & mask, ((wide * _TURN) >> np.uint64(32)) & mask


def sketch(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Coordinatewise maxima of the frequencies; 255 stands for that and anything above."""
    out = np.zeros(max(LEAST_WIDTH, 1 << (SPREAD * len(hashes) - 1).bit_length()), np.uint8)
    capped = np.minimum(counts, 255).astype(np.uint8)
    for at in _coordinates(hashes, len(out)):
        np.maximum.at(out, at, capped)
    return out


def bounds_on_counts(sketched: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For each hashed term a frequency that is not below its own."""
    one, two = _coordinates(hashes, len(sketched))
    return np.minimum(sketched[one], sketched[two])


def _shares(n: int, corpus: Corpus) -> np.ndarray:
    """A term's share, by its frequency from 0 to 254, in a document of ``n`` terms; at 255 above any."""
    tf = np.arange(255, dtype=np.int64)
    return np.append((10**9 * tf) // (1000 * tf + 8 * _norm(n, corpus)), MOST_PART)


def _norm(n: int, corpus: Corpus) -> int:
    return 100 - 75 + 75 * n * corpus.documents // corpus.terms


def query_terms(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct queries (item, item_id), and their terms (item, term, times, hash), from rows (item_id, text)."""
    ship(items.sparkSession)
    bounded_batches(items.sparkSession)
    own = items.select(F.col("item_id"), F.col("text").cast("binary").alias("text")).dropDuplicates()
    own = materialize(own.withColumn("item", F.monotonically_increasing_id()), "lexical-items")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text")):
                counts = Counter(terms_of(text.as_py()))
                terms = list(counts)
                yield pa.RecordBatch.from_pydict({
                    "item": pa.array([item] * len(terms), pa.int64()), "term": pa.array(terms, pa.binary()),
                    "times": pa.array(list(counts.values()), pa.int64()), "hash": pa.array(_hashes(terms).astype(np.int64)),
                })

    terms = own.select("item", "text").mapInArrow(split, "item long, term binary, times long, hash long")
    return own.select("item", "item_id"), materialize(terms, "lexical-terms")


def index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Rows (key, n, sketch) for documents with terms, and rows (term, df) with counts of terms that may be in ``terms``."""
    spark = docs.sparkSession
    ship(spark)
    bounded_batches(spark)
    wanted = np.zeros(COARSE + 1, bool)
    wanted[terms.select(F.col("hash").bitwiseAND(F.lit(COARSE)).alias("c")).distinct().toArrow().column("c").to_numpy()] = True
    shared = spark.sparkContext.broadcast(wanted)

    def counted(found: Counter) -> pa.RecordBatch:
        none = pa.nulls(len(found))
        return pa.RecordBatch.from_arrays(
            [none.cast(key_type[0]), none.cast(pa.int64()), none.cast(pa.binary()), pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())],
            names=["key", "n", "sketch", "term", "df"],
        )

    key_type: list[pa.DataType] = []

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            key_type[:] = [batch.schema.field("key").type]
            rows, sizes, sketches = [], [], []
            for row, text in enumerate(batch.column("text")):
                counts = Counter(terms_of(text.as_py()))
                if not counts:
                    continue
                own = list(counts)
                hashes = _hashes(own)
                tf = np.fromiter(counts.values(), np.int64, len(own))
                rows.append(row)
                sizes.append(int(tf.sum()))
                sketches.append(sketch(hashes, tf).tobytes())
                found.update([own[i] for i in np.flatnonzero(shared.value[hashes & COARSE]).tolist()])
            none = pa.nulls(len(rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()), pa.array(sketches, pa.binary()), none.cast(pa.binary()), none.cast(pa.int64())],
                names=["key", "n", "sketch", "term", "df"],
            )
            if len(found) > HELD_TERMS:
                yield counted(found)
                found = Counter()
        if found:
            yield counted(found)

    rows = docs.select(text_key(F.col("doc_id"), F.col("text")).alias("key"), F.col("text").cast("binary").alias("text"))
    return materialize(rows.mapInArrow(indexed, f"{KEY}, n long, sketch binary, term binary, df long"), "lexical-index")


def corpus_of(indexed: DataFrame) -> Corpus:
    row = indexed.agg(F.count("n").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    return Corpus(row["documents"], row["terms"])


def weighted(terms: DataFrame, indexed: DataFrame, corpus: Corpus) -> DataFrame:
    """(item, term, hash, weight) of the query terms that occur in documents; a weight counts repeats in the query."""
    df = indexed.where("term is not null").groupBy("term").agg(F.sum("df").alias("df"))
    one = F.floor(1000 * F.log(F.lit(float(2 * corpus.documents + 2)) / (2 * F.col("df") + 1).cast("double")))
    return materialize(terms.join(df, "term").select("item", "term", "hash", (F.col("times") * one).alias("weight")), "lexical-weights")


def blocks(weights: DataFrame) -> Iterator[Block]:
    """The queries in blocks of bounded size."""
    n = weights.count()
    pieces = 1 if n <= BLOCK_TERMS else math.ceil(2 * n / BLOCK_TERMS)
    for piece in range(pieces):
        some = weights.where(F.pmod(F.xxhash64("item"), F.lit(pieces)) == piece).toArrow().sort_by("item")
        if not some.num_rows:
            continue
        items, starts = np.unique(some.column("item").to_numpy(), return_index=True)
        coded = some.column("term").combine_chunks().dictionary_encode()
        terms = coded.dictionary.to_pylist()
        yield Block(items, starts, coded.indices.to_numpy(), some.column("weight").to_numpy(), terms, _hashes(terms))


def _bounds(block: Block, sketched: bytes, n: int, corpus: Corpus) -> np.ndarray:
    """An upper bound on the score of each query of the block."""
    tf = bounds_on_counts(np.frombuffer(sketched, np.uint8), block.hashes)
    return np.add.reduceat(block.weights * _shares(n, corpus)[tf][block.places], block.starts)


def _highest(indexed: DataFrame, shared, corpus: Corpus, k: int) -> DataFrame:
    """(item, key, bound): the ``k`` documents with the highest bounds, of each query and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        heaps: list[list] = [[] for _ in block.items]
        bar = np.zeros(len(heaps), np.int64)
        kind, serial = None, 0
        for batch in batches:
            kind = batch.schema.field("key").type
            keys = batch.column("key")
            for row, (n, sketched) in enumerate(zip(batch.column("n").to_pylist(), batch.column("sketch").to_pylist())):
                found = _bounds(block, sketched, n, corpus)
                for q in np.flatnonzero(found > bar).tolist():
                    serial += 1
                    entry = (int(found[q]), -serial, keys[row])
                    if len(heaps[q]) < k:
                        heapq.heappush(heaps[q], entry)
                    else:
                        heapq.heapreplace(heaps[q], entry)
                    if len(heaps[q]) == k:
                        bar[q] = heaps[q][0][0]
        if kind is not None:
            rows = [(int(block.items[q]), key.as_py(), bound) for q, heap in enumerate(heaps) for bound, _, key in heap]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], kind), pa.array([r[2] for r in rows], pa.int64())],
                names=["item", "key", "bound"],
            )

    return indexed.select("key", "n", "sketch").mapInArrow(run, f"item long, {KEY}, bound long")


def _reaching(indexed: DataFrame, shared, corpus: Corpus, thresholds: dict[int, int]) -> DataFrame:
    """(item, key, bound): all documents whose bound is positive and reaches the query's threshold."""
    least = np.array([max(1, thresholds.get(int(i), 1)) for i in shared.value.items])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            rows, items, found = [], [], []
            for row, (n, sketched) in enumerate(zip(batch.column("n").to_pylist(), batch.column("sketch").to_pylist())):
                bound = _bounds(block, sketched, n, corpus)
                at = np.flatnonzero(bound >= least)
                rows.append(np.full(len(at), row))
                items.append(block.items[at])
                found.append(bound[at])
            rows, items, found = (np.concatenate([*x, np.empty(0, np.int64)]).astype(np.int64) for x in (rows, items, found))
            yield pa.RecordBatch.from_arrays([pa.array(items), batch.column("key").take(pa.array(rows)), pa.array(found)], names=["item", "key", "bound"])

    return indexed.select("key", "n", "sketch").mapInArrow(run, f"item long, {KEY}, bound long")


def scored(docs: DataFrame, candidates: DataFrame, shared, corpus: Corpus) -> DataFrame:
    """(item, key, score), exact and written, of the distinct candidates (item, key)."""
    coarse = F.xxhash64("key").bitwiseAND(F.lit(COARSE))
    keys = candidates.groupBy("key").agg(F.collect_set("item").alias("items"))  # at most the queries of a block
    near = F.broadcast(candidates.select(coarse.alias("c")).distinct())
    texts = docs.select(text_key(F.col("doc_id"), F.col("text")).alias("key"), F.col("text").cast("binary").alias("text"))
    texts = texts.join(near, coarse == F.col("c"), "left_semi").join(keys, "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        at = {int(item): q for q, item in enumerate(block.items)}
        ends = np.append(block.starts[1:], len(block.places))
        for batch in batches:
            rows, items, scores = [], [], []
            for row, (text, wanted) in enumerate(zip(batch.column("text"), batch.column("items").to_pylist())):
                counts = Counter(terms_of(text.as_py()))
                norm = 8 * _norm(counts.total(), corpus)
                for item in wanted:
                    span = slice(block.starts[at[item]], ends[at[item]])
                    tf = np.array([counts.get(block.terms[p], 0) for p in block.places[span]], np.int64)
                    rows.append(row)
                    items.append(item)
                    scores.append(int((block.weights[span] * ((10**9 * tf) // (1000 * tf + norm))).sum()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.int64()), batch.column("key").take(pa.array(rows, pa.int64())), pa.array(scores, pa.int64())], names=["item", "key", "score"]
            )

    exact = texts.mapInArrow(run, f"item long, {KEY}, score long")
    return materialize(exact.dropDuplicates(["item", "key"]), "lexical-scored")


def _first(rows: DataFrame, by: str, k: int) -> DataFrame:
    """The ``k`` rows of each query that are highest in ``by``, equal ones by id."""
    place = Window.partitionBy("item").orderBy(F.desc(by), "key")
    return rows.withColumn("place", F.row_number().over(place)).where(F.col("place") <= k)


def _thresholds(best: DataFrame, k: int) -> dict[int, int]:
    """The k-th best score of each query of a block that has k."""
    return {r["item"]: r["score"] for r in best.where(F.col("place") == k).select("item", "score").toLocalIterator()}


def _search_block(docs: DataFrame, indexed: DataFrame, block: Block, corpus: Corpus, k: int) -> DataFrame:
    """(item, key, score): the best ``k`` of each query of the block, a row for documents alike in id and text."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(block)
    ids = indexed.where("term is null")
    portion = FIRST * k
    now = materialize(_first(_highest(ids, shared, corpus, portion), "bound", portion).select("item", "key"), "lexical-first")
    known = best = scored(docs, now, shared, corpus)
    best = materialize(_first(best.where("score > 0"), "score", k), "lexical-best")
    left = materialize(_reaching(ids, shared, corpus, _thresholds(best, k)).join(known, ["item", "key"], "left_anti").distinct(), "lexical-left")
    while not left.isEmpty():
        portion *= MORE
        now = materialize(_first(left, "bound", portion).select("item", "key"), "lexical-portion")
        fresh = scored(docs, now, shared, corpus)
        best = materialize(_first(best.drop("place").union(fresh.where("score > 0")), "score", k), "lexical-best")
        kth = best.where(F.col("place") == k).select("item", F.col("score").alias("least"))
        open_ = left.join(now, ["item", "key"], "left_anti").join(F.broadcast(kth), "item", "left")
        left = materialize(open_.where(F.col("bound") >= F.coalesce("least", F.lit(1))).drop("least"), "lexical-left")
    return best.select("item", "key", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): for each query the ``k`` documents with the highest positive scores."""
    queries, terms = query_terms(items)
    indexed = index(docs, terms)
    corpus = corpus_of(indexed)
    weights = weighted(terms, indexed, corpus)
    parts = [_search_block(docs, indexed, block, corpus, k) for block in blocks(weights)]
    if not parts:
        none = items.select("item_id").where(F.lit(False))
        return none.join(docs.select("doc_id").where(F.lit(False))).select(
            "item_id", F.lit(0).alias("rank"), F.col("doc_id").cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")
        )
    best = reduce(DataFrame.union, parts)
    # Documents alike in id and text were scored once; they are results each.
    copies = indexed.join(best.select("key").distinct(), "key").groupBy("key").agg(F.count("*").alias("copies"))
    each = best.join(copies, "key").withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)))))
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "key", "copy"))
    ranked = each.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.join(queries, "item").select("item_id", "rank", F.col("key.doc_id").alias("doc_id"), "score")
