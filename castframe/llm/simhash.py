"""SimHash near-duplicates: fingerprints, pigeonhole blocks, exact Hamming distance.

Two fingerprints that differ in k bits at most agree on all but k of any m
blocks of bits. Each fingerprint is therefore listed under every choice of m - k
blocks, and only fingerprints listed under the same bits are compared. A list
that is too long for one task is not cut: its fingerprints are listed again by
more and finer blocks, and the finest lists are bounded by their few free bits.
Comparing a list yields a spanning forest of its links, never all its pairs.

Defined cases: a text that is null or has no words has fingerprint zero and links
like any other; fewer words than a shingle form one shingle. Equal fingerprints
are compared once. A null id is in no smallest id unless its component has no
other. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from castframe.llm import linededup
from castframe.llm.common import bounded_batches, components, text_key, whole_row
from castframe.session import materialize, ship

LEVELS = (6, 10, 16)  # blocks; a list of the last agrees in 52 bits, so it has 4,096 members at most
LONGEST_LIST = 512
# Of the pipeline's near copies: bits of a block, blocks, and bits of 128 that near ones differ in at most.
BLOCK, TABLES, APART = 14, 65, 40
FEW = 64  # members of a list that is compared together with others
BITS = 128 + BLOCK * TABLES + -(BLOCK * TABLES) % 8  # eight of a number
_STEPS = np.arange(1, BITS // 8 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def fingerprint_of(text: str | None, words: int = 3) -> int:
    """The fingerprint as a signed 64-bit number."""
    found = (text or "").encode("utf-8", "replace").lower().split()  # A-Z and ASCII white space
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) > words:
        ends = np.cumsum([len(w) + 1 for w in found])
        starts = np.concatenate([[0], ends[: len(found) - words]]).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], 42) for s, e in zip(starts, (ends[words - 1 :] - 1).tolist())]
    else:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = np.array(hashes[at : at + (1 << 14)], "<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, key: Column, text_col: str = "text", words: int = 3) -> DataFrame:
    """Rows (key, fp) for each row of ``docs``."""
    ship(docs.sparkSession)
    bounded_batches(docs.sparkSession)
    rows = docs.select(key.alias("key"), F.col(text_col).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [fingerprint_of(t.as_py(), words) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(got, pa.int64())], names=["key", "fp"])

    return rows.mapInArrow(hashed, f"key {kind}, fp long")


def _masks(blocks: int, distance: int) -> list[int]:
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    spans = [sum(1 << bit for bit in range(a, b)) for a, b in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in combinations(spans, blocks - distance)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges that span the links of one list: breadth first, over what is not yet reached."""
    left, edges = np.unique(fps).view(np.uint64), []  # bits are counted without a sign
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            close = np.bitwise_count(left ^ front[0]) <= distance
            edges += [(x, int(front.view(np.int64)[0])) for x in left[close].view(np.int64).tolist()]
            front, left = np.concatenate([front[1:], left[close]]), left[~close]
    return edges


def links(fps: DataFrame, distance: int = 3) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` that connect all linked ones."""
    found, todo = [], fps.select("fp").distinct()
    for level, blocks in enumerate(LEVELS):
        masks = _masks(blocks, distance)
        listed = todo.select(
            F.explode(F.array(*[F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(masks)])).alias("l"), "fp"
        ).select("l.mask", "l.bits", "fp")
        sizes = listed.groupBy("mask", "bits").count().where("count > 1")
        shared = listed.join(sizes, ["mask", "bits"])
        last = level == len(LEVELS) - 1
        short = shared if last else shared.where(F.col("count") <= LONGEST_LIST)

        def spanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, name = [], None
            out: list[tuple[int, int]] = []
            for batch in batches:
                mask, bits, fp = (batch.column(c).to_numpy() for c in ("mask", "bits", "fp"))
                cuts = np.flatnonzero((np.diff(mask) != 0) | (np.diff(bits) != 0)) + 1
                for at, part in zip([0, *cuts.tolist()], np.split(fp, cuts)):
                    if not len(part):
                        continue
                    if name != (mask[at], bits[at]) and held:
                        out += _forest(np.concatenate(held), distance)
                        held = []
                    name = (mask[at], bits[at])
                    held.append(part)
                yield pa.RecordBatch.from_pydict({"a": pa.array([x[0] for x in out], pa.int64()), "b": pa.array([x[1] for x in out], pa.int64())})
                out = []
            if held:
                out = _forest(np.concatenate(held), distance)
                yield pa.RecordBatch.from_pydict({"a": pa.array([x[0] for x in out], pa.int64()), "b": pa.array([x[1] for x in out], pa.int64())})

        pairs = short.select("mask", "bits", "fp").repartition("mask", "bits").sortWithinPartitions("mask", "bits").mapInArrow(spanned, "a long, b long")
        found.append(materialize(pairs.distinct(), f"simhash-links{level}"))
        if last:
            break
        todo = materialize(shared.where(F.col("count") > LONGEST_LIST).select("fp").distinct(), f"simhash-long{level}")
        if todo.isEmpty():
            break
    edges = found[0]
    for more in found[1:]:
        edges = edges.union(more)
    return edges.distinct()


def near_duplicates(docs: DataFrame, key: Column, text_col: str = "text", words: int = 3, distance: int = 3) -> DataFrame:
    """Rows (key, fp, first): each row's fingerprint and the smallest key of its component."""
    marked = materialize(fingerprints(docs, key, text_col, words), "simhash-fingerprints")
    firsts = materialize(marked.groupBy("fp").agg(F.min("key").alias("first")), "simhash-distinct")
    roots = components(links(firsts, distance), "simhash").withColumnRenamed("node", "fp")
    rooted = firsts.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    of_print = rooted.join(least, "root").select("fp", F.col("least").alias("first"))
    return marked.join(of_print, "fp").select("key", "fp", "first")


def plain_words(text: Column) -> Column:
    """Words as in ``fingerprint_of``, with one space between them."""
    low = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.trim(F.regexp_replace(low, r"[ \t\n\r\x0b\f]+", " "))


def word_shingles(plain: Column, words: int) -> Column:
    """The 64-bit hashes of the distinct runs of ``words`` words; fewer words form one."""

    def runs(own: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(own) - (words - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(own, i, F.lit(words))))

    return F.array_distinct(F.flatten(F.transform(F.array(F.split(plain, " ")), runs)))  # nested, so that a text is split once


def long_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """The bits of a fingerprint for blocks and sketch, from the 64-bit hashes of distinct shingles.

    A shingle's hash gives a number from -128 to 127 for each bit, and a bit is the sign of
    their sum. With such weights few shingles make no ties, so sets of any size differ in as many bits.
    """
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 10):
        mixed = hashes[at : at + (1 << 10)].view(np.uint64)[:, None] + _STEPS
        mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        total += (mixed ^ (mixed >> np.uint64(31))).view(np.int8).sum(axis=0, dtype=np.int32)
    return total * 2 > -len(hashes)  # the mean of the numbers is -1/2


def _blocks(sets: DataFrame) -> DataFrame:
    """(l1, l2, lists, x, y) of rows (l1, l2, s): the block values of the fingerprint, each with its table, and 128 further bits."""
    ship(sets.sparkSession)
    powers = 1 << np.arange(BLOCK, dtype=np.int64)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("s")
            ends, flat = hashes.offsets.to_numpy(), hashes.values.to_numpy()
            lists, sketches = [], []
            for start, end in zip(ends, ends[1:]):
                bits = long_fingerprint(flat[start:end])
                lists.append(bits[128 : 128 + TABLES * BLOCK].reshape(TABLES, BLOCK) @ powers + (np.arange(TABLES) << BLOCK))
                sketches.append(np.packbits(bits[:128]).view(np.int64))
            x, y = np.array(sketches, np.int64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("l1"), batch.column("l2"), pa.array(lists, pa.list_(pa.int64())), pa.array(x), pa.array(y)],
                names=["l1", "l2", "lists", "x", "y"],
            )

    return sets.mapInArrow(made, "l1 long, l2 long, lists array<long>, x long, y long")


def _near(sketch: np.ndarray, others: np.ndarray) -> np.ndarray:
    return np.bitwise_count(sketch ^ others).sum(axis=-1) <= APART


def _groups(sketches: np.ndarray) -> np.ndarray:
    """For each sketch the place of the first of its group: those that are near one another, directly or through others."""
    root = np.arange(len(sketches))
    if len(sketches) <= 256 and np.count_nonzero(_near(sketches[:, None], sketches)) == len(sketches):
        return root
    left = root.copy()
    while len(left):
        first, front, left = left[0], [left[0]], left[1:]
        while front and len(left):
            near = _near(sketches[front.pop()], sketches[left])
            root[left[near]] = first
            front += left[near].tolist()
            left = left[~near]
    return root


def _with_near_pairs(rows: np.ndarray) -> np.ndarray:
    """The rows (list, l1, l2, x, y) of lists in which some are near, or that have more than ``FEW`` members."""
    names, sketches = rows[:, 0], rows[:, 3:].view(np.uint64)
    wanted = np.zeros(len(rows), bool)
    for apart in range(1, FEW + 1):  # all lists at once
        at = np.flatnonzero(names[apart:] == names[:-apart])
        if not len(at):
            break
        wanted[at] |= _near(sketches[at], sketches[at + apart]) | (apart == FEW)
    return rows[np.isin(names, np.unique(names[wanted]))]


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (l1, l2, list, root) of the groups of two or more in lists that arrive one after the other."""
    held: list[np.ndarray] = []  # of the list that the batch before ended in

    def bands(rows: np.ndarray) -> Iterator[np.ndarray]:
        rows = _with_near_pairs(rows)
        cuts = np.flatnonzero(np.diff(rows[:, 0])) + 1
        for part in np.split(rows, cuts):
            if len(part) > 1:
                root = _groups(part[:, 3:].view(np.uint64))
                several = np.bincount(root, minlength=len(root))[root] > 1
                if several.any():
                    yield np.column_stack([part[several, :3], part[root[several], 1]])

    def out(found: list[np.ndarray]) -> pa.RecordBatch:
        name, l1, l2, root = np.concatenate(found or [np.empty((0, 4), np.int64)]).T
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (l1, l2, name, root)], names=["l1", "l2", "list", "root"])

    for batch in batches:
        rows = np.column_stack([batch.column(c).to_numpy() for c in ("list", "l1", "l2", "x", "y")])
        if not len(rows):
            continue
        same = len(rows) if rows[0, 0] == rows[-1, 0] else int(np.flatnonzero(rows[:, 0] != rows[-1, 0])[-1]) + 1
        if held and held[0][0, 0] == rows[-1, 0]:  # the whole batch goes on with the list
            held.append(rows)
            continue
        same = 0 if rows[0, 0] == rows[-1, 0] else same
        yield out(list(bands(np.concatenate([*held, rows[:same]]))))
        held = [rows[same:]]
    if held:
        yield out(list(bands(np.concatenate(held))))


def near_bands(sets: DataFrame) -> DataFrame:
    """(l1, l2, bands) of rows (l1, l2, s) that have near copies: what they share a band with agrees in a block and is near in Hamming distance."""
    blocks = materialize(_blocks(sets), "near-prints")
    listed = blocks.select(F.explode("lists").alias("list"), "l1", "l2", "x", "y")
    found = listed.repartition("list").sortWithinPartitions("list").mapInArrow(_grouped, "l1 long, l2 long, list long, root long")
    return found.groupBy("l1", "l2").agg(F.collect_list(F.xxhash64("list", "root")).alias("bands"))


def keep_first(docs: DataFrame, words: int = 5, threshold: float = 0.8) -> DataFrame:
    """One row of each group of near copies, the one with the smallest id and then text.

    Near copies have a Jaccard similarity of ``threshold`` or more on their shingles,
    which is computed exactly. Candidates come from SimHash fingerprints of the same shingles:
    texts at 0.8 differ in 15 of 100 bits, so 99.8 % of them agree in one of 65 blocks of
    14 bits. Within a block, texts are grouped by the Hamming distance of 128 further bits,
    of which unrelated ones differ in 64, give or take 6, and those at 0.8 in 19, give or take 4;
    the groups take the place of bands. All pairs of a group are judged. A list of texts alike in a
    block by chance grows with the table (one text in 16,384), in a task's vector operations alone.
    """
    keyed = docs.select(text_key(F.col("doc_id"), F.col("text")).alias("_key"), whole_row(docs).alias("_row"), F.col("text").alias("_text"))
    texts = keyed.select(F.col("_key").alias("key"), plain_words(F.col("_text")).alias("line"))
    texts = texts.withColumns({"l1": F.xxhash64("line"), "l2": F.xxhash64(F.lit(1), "line")})

    def taken(plain: Column) -> Column:
        return word_shingles(plain, words)

    distinct = texts.select("l1", "l2", "line").dropDuplicates(["l1", "l2"])
    bounded_batches(docs.sparkSession)
    signed = materialize(near_bands(distinct.select("l1", "l2", taken(F.col("line")).alias("s"))), "near-signed")
    roots = linededup.similar(signed, texts, threshold, taken)
    rooted = texts.select("key", "l1", "l2").join(roots, ["l1", "l2"], "left")
    least = rooted.groupBy(F.coalesce("r1", "l1").alias("r1"), F.coalesce("r2", "l2").alias("r2")).agg(F.min("key").alias("_kept"))
    kept = materialize(least.select("_kept"), "near-kept")
    # Rows that are alike in id and text share their key; one of them stays.
    joined = keyed.join(kept, F.col("_key").eqNullSafe(F.col("_kept")), "left_semi")
    return joined.dropDuplicates(["_key"]).select("_row.*")
