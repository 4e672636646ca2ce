"""Suffix-array dedup with a run-length index of the repetitive part of a corpus.

A string of ``length`` bytes that occurs twice holds the same anchor in both places:
the least hashed of its shorter substrings. Every text is cut into pieces, one for each
maximal run of strings with the same anchor. Equal pieces are collapsed first, and
pieces whose anchor occurs once are done. What remains is the repetitive part. It is
dealt by anchor into texts that fit a task; for each, a Burrows-Wheeler transform is
built and reduced to its runs, with the suffix array sampled at the ends of runs.
Matching statistics are streamed from these samples alone: between two samples, the
neighbour in the suffix array moves along and the match gets shorter by one. Strings
with matches of ``length`` bytes and an earlier occurrence are marked.

Defined cases: a null text is empty; texts shorter than ``length`` lose nothing. A
null id comes after all others. Rows alike in id and text are one document and are
answered alike; rows alike in id only are ordered by a hash of their text. Extra
columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from castframe.llm.common import bounded_batches, text_key
from castframe.llm.decontaminate import merged
from castframe.session import materialize, ship

LENGTH, ANCHOR = 100, 28
SLICE = 2 << 20  # bytes hashed at once
TEXT = 1 << 20  # bytes of one index, or the pieces of one anchor
MOST_PIECES = 32_768  # of one anchor; beyond, its strings are grouped one by one
_LAST = (1 << 63) - 1


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """Hashes of substrings of one slice, from running sums of bytes times powers."""

    def __init__(self):
        self.held = [(np.empty(0, np.uint64), np.empty(0, np.uint64))] * 2

    def _tables(self, which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.held[which][0]) <= n:
            base = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)[which]
            self.held[which] = (_powers(n, base), _powers(n, pow(base, -1, 1 << 64)))
        return self.held[which]

    def sums(self, data: np.ndarray, which: int) -> np.ndarray:
        power = self._tables(which, len(data))[0]
        return np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], dtype=np.uint64)])

    def spans(self, sums: np.ndarray, which: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        x = (sums[end] - sums[start]) * self._tables(which, len(sums))[1][start]
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    n = len(values) - width + 1
    rows = -(-len(values) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def pieces_of(hasher: Hasher, data: np.ndarray, ends: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Of texts laid end to end: first string, number of strings, anchor and hash of each piece."""
    none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    if len(data) < length:
        return none
    places = np.arange(len(data) - anchor + 1)
    sums = hasher.sums(data, 0)
    hashes = hasher.spans(sums, 0, places, places + anchor)
    mask = np.uint64((1 << 24) - 1)
    at = (_least((hashes & ~mask) | places.astype(np.uint64), length - anchor + 1) & mask).astype(np.int64)
    owner = np.repeat(np.arange(len(ends)), np.diff(np.concatenate([[0], ends])))
    string = np.arange(len(at))
    string = string[ends[owner[: len(at)]] - string >= length]
    if not len(string):
        return none
    cut = np.flatnonzero(np.concatenate([[True], (np.diff(at[string]) != 0) | (np.diff(string) != 1)]))
    first = string[cut]
    count = np.diff(np.concatenate([cut, [len(string)]]))
    other = hasher.sums(data, 1)
    return first, count, hashes[at[first]], hasher.spans(other, 1, first, first + count - 1 + length)


def _sliced(batch: pa.RecordBatch, length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Parts of texts as (row, offset, bytes), about SLICE bytes at a time; parts of one text share length - 1 bytes."""
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for row, text in enumerate(batch.column("text")):
        body = text.as_buffer()
        for offset in range(0, max(len(body) - length + 1, 0), SLICE):
            part = memoryview(body)[offset : offset + SLICE + length - 1]
            if held and size + len(part) > SLICE + length:
                yield held
                held, size = [], 0
            held.append((row, offset, part))
            size += len(part)
    if held:
        yield held


def _laid(held: list) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(part for _, _, part in held), np.uint8), np.cumsum([len(part) for _, _, part in held])


def _anchors(length: int, anchor: int):
    """Texts to (anchor, n), how many pieces of a slice have it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for held in _sliced(batch, length):
                names, n = np.unique(pieces_of(hasher, *_laid(held), length, anchor)[2], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(n)], names=["anchor", "n"])

    return count


def _cut(length: int, anchor: int):
    """Texts to rows (anchor, content, doc_id, hash, at, gone); at is start * 256 + strings.

    Of equal pieces in one slice only the earliest goes on to be compared. The others are
    gone already; they need no company, so any number takes the place of their anchor.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            ids, hashes = batch.column("doc_id").to_numpy(), batch.column("hash").to_numpy()
            for held in _sliced(batch, length):
                data, ends = _laid(held)
                first, count, anchors, content = pieces_of(hasher, data, ends, length, anchor)
                part = np.searchsorted(ends, first, side="right")
                row = np.array([r for r, _, _ in held])[part]
                start = first - np.concatenate([[0], ends])[part] + np.array([o for _, o, _ in held])[part]
                places = ids[row], hashes[row], start * 256 + count
                order = np.lexsort((*places[::-1], content, anchors))
                gone, same = np.empty(len(order), bool), np.empty(len(order), bool)
                gone[order], same[order] = _again((anchors[order], content[order]), [x[order] for x in places], None)
                spread = (anchors ^ content) * np.uint64(0x9E3779B97F4A7C15) + row.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
                columns = [np.where(gone, spread, anchors).view(np.int64), content.view(np.int64), *places, gone]
                yield pa.RecordBatch.from_arrays([pa.array(x[~same]) for x in columns], names=["anchor", "content", "doc_id", "hash", "at", "gone"])

    return cut


def _again(names: tuple, places: list[np.ndarray], before: tuple | None) -> tuple[np.ndarray, np.ndarray]:
    """For sorted rows: which are not at the first place of their name, and which repeat that place.

    ``before`` is the name and first place of the row before these."""
    n = len(names[0])
    if not n:
        return np.empty(0, bool), np.empty(0, bool)
    new = np.concatenate([[True], np.any([x[1:] != x[:-1] for x in names], axis=0)])
    leader = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    at_first = np.all([x == x[leader] for x in places], axis=0)
    follows = np.zeros(n, bool)
    if before is not None and before[0] == tuple(x[0] for x in names):
        follows = leader == 0
        at_first[follows] = np.all([x[follows] == y for x, y in zip(places, before[1])], axis=0)
    return ~at_first, at_first & (~new | follows)


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by content and place: equal pieces are gone but for the first."""
    before: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        anchor, content, doc, text_hash, at, gone = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "content", "doc_id", "hash", "at", "gone"))
        # Rows gone already are under names of their own, where none that is not gone is after them.
        again, same = _again((anchor, content, gone), [doc, text_hash, at], before)
        name = (anchor[-1], content[-1], gone[-1])
        if before is None or before[0] != name:
            leader = len(anchor) - 1
            while leader and (anchor[leader - 1], content[leader - 1], gone[leader - 1]) == name:
                leader -= 1
            before = (name, (doc[leader], text_hash[leader], at[leader]))
        keep = ~same | gone
        columns = [anchor, doc, text_hash, at, gone | again]
        yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in columns], names=["anchor", "doc_id", "hash", "at", "gone"])


class RunIndex:
    """A Burrows-Wheeler transform of texts, kept as runs with samples at their ends."""

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        """``data``: texts of at most 255 bytes, each followed by one byte that ends it, at ``ends``."""
        n = len(data)
        symbols = data.astype(np.int64) + 1
        symbols[ends] = 0
        stop = ends[np.searchsorted(ends, np.arange(n))]  # nothing after the end of a text counts
        order = _suffix_order(symbols, stop)
        before = symbols[order - 1]
        before[order == 0] = 0
        head = np.concatenate([[True], (before[1:] != before[:-1]) | (before[1:] == 0)])
        heads = np.flatnonzero(head)
        self.run_symbols, self.run_starts = before[heads], heads
        # The suffix at a run's start, and its neighbour, the suffix at the end of the run before.
        starts, neighbours = order[heads], np.concatenate([[-1], order[heads[1:] - 1]])
        matched = np.concatenate([[0], _common(symbols, stop, starts[1:], neighbours[1:])])
        by_place = np.argsort(starts)
        self.places, self.neighbours, self.matched = starts[by_place], neighbours[by_place], matched[by_place]

    def matching(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For suffixes in the order of the text: the length of the match with the neighbour
        before them in the suffix array, and that neighbour."""
        sample = np.searchsorted(self.places, at, side="right") - 1
        moved = at - self.places[sample]
        return self.matched[sample] - moved, self.neighbours[sample] + moved


def _suffix_order(symbols: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Suffixes sorted up to the end of their text, equal ones by place."""
    n = len(symbols)
    width = 6
    padded = np.concatenate([symbols, np.zeros(width, np.int64)])
    left = stop - np.arange(n)
    key = np.zeros(n, np.int64)
    for i in range(width):
        key = key * 257 + np.where(left >= i, padded[i : i + n], 0)
    longest = int(left.max()) + 1
    order = np.argsort(key)
    while True:
        rank = np.empty(n, np.int64)
        sorted_key = key[order]
        rank[order] = np.cumsum(np.concatenate([[1], sorted_key[1:] != sorted_key[:-1]]))
        if width >= longest:
            return np.sort((rank << 32) | np.arange(n)) & 0xFFFFFFFF
        next_rank = np.zeros(n, np.int64)
        next_rank[: n - width] = rank[width:]
        next_rank[left < width] = 0
        key = (rank << 32) | next_rank
        order = np.argsort(key)
        width *= 2


def _common(symbols: np.ndarray, stop: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols the suffixes at ``a`` and ``b`` share, up to the ends of their texts."""
    most = np.minimum(stop[a] - a, stop[b] - b)
    out = np.zeros(len(a), np.int64)
    going = np.flatnonzero(most > 0)
    while len(going):
        same = symbols[a[going] + out[going]] == symbols[b[going] + out[going]]
        going = going[same]
        out[going] += 1
        going = going[out[going] < most[going]]
    return out


def repeated(texts: list[bytes], counts: np.ndarray, length: int) -> list[list[tuple[int, int]]]:
    """For texts in order: the runs (first, last) of their first ``count`` strings of ``length``
    bytes that also start earlier."""
    data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    sizes = np.array([len(t) + 1 for t in texts])
    ends = np.cumsum(sizes) - 1
    first = ends - sizes + 1
    index = RunIndex(data, ends)
    owner = np.repeat(np.arange(len(texts)), counts)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = first[owner] + offset
    size, neighbour = index.matching(at)
    # Equal strings are neighbours of neighbours: follow them to the first, and take the least.
    link = np.arange(len(data))
    link[at] = np.where(size >= length, neighbour, at)
    root = link[at]
    while True:
        further = link[root]
        if np.array_equal(further, root):
            break
        link[at] = further
        root = link[at]
    least = np.full(len(data), len(data))
    np.minimum.at(least, root, at)
    marked = np.flatnonzero(least[root] < at)
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    if len(marked):
        cut = np.flatnonzero((np.diff(marked) != 1) | (np.diff(owner[marked]) != 0)) + 1
        for run in np.split(marked, cut):
            out[owner[run[0]]].append((int(offset[run[0]]), int(offset[run[-1]])))
    return out


def _index_anchors(length: int):
    """Pieces sorted by anchor and place to the spans that repeat; whole anchors go together."""

    def flush(held: list) -> pa.RecordBatch:
        found = repeated([x[3] for x in held], np.array([x[2] & 255 for x in held]), length)
        spans = [(x[0], x[1], (x[2] >> 8) + a, (x[2] >> 8) + b + length) for x, runs in zip(held, found) for a, b in runs]
        return pa.RecordBatch.from_arrays([pa.array([s[i] for s in spans], pa.int64()) for i in range(4)], names=["doc_id", "hash", "start", "end"])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list = []
        group: list = []
        size = 0
        name = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("anchor", "doc_id", "hash", "at", "piece")]
            for anchor, *rest in zip(*columns):
                if anchor != name:
                    done += group
                    group = []
                    name = anchor
                    if size > TEXT:
                        yield flush(done)
                        done, size = [], 0
                group.append(rest)
                size += len(rest[3])
        if done or group:
            yield flush(done + group)

    return mark


def _pick(length: int):
    """Documents with the places of their pieces to rows with the pieces' bytes."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                body = batch.column("text")[row].as_py().encode("utf-8", "replace")
                wanted = batch.column("pieces")[row].values
                at = wanted.field("at").to_numpy()
                cut = [body[a >> 8 : (a >> 8) + (a & 255) - 1 + length] for a in at.tolist()]
                for i in range(0, len(cut), 1 << 15):
                    part = slice(i, i + (1 << 15))
                    n = len(cut[part])
                    yield pa.RecordBatch.from_arrays(
                        [
                            wanted.field("anchor").slice(i, n),
                            pa.array([batch.column("doc_id")[row].as_py()] * n, pa.int64()), pa.array([batch.column("hash")[row].as_py()] * n, pa.int64()),
                            wanted.field("at").slice(i, n), pa.array(cut[part], pa.binary()),
                        ],
                        names=["anchor", "doc_id", "hash", "at", "piece"],
                    )

    return pick


def _one_by_one(many: DataFrame, length: int) -> DataFrame:
    """The spans of anchors with very many pieces: their strings, grouped by content.

    The group's least place is an aggregate, so no task sees a whole group."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, doc, text_hash, at, piece in zip(*[batch.column(c).to_pylist() for c in ("anchor", "doc_id", "hash", "at", "piece")]):
                n = at & 255
                names = [hashlib.blake2b(piece[i : i + length], digest_size=16).digest() for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.binary()), pa.array([doc] * n, pa.int64()), pa.array([text_hash] * n, pa.int64()), pa.array([(at >> 8) + i for i in range(n)], pa.int64())],
                    names=["string", "doc_id", "hash", "start"],
                )

    listed = materialize(many.mapInArrow(strings, "string binary, doc_id long, hash long, start long"), "repeats-strings")
    place = F.struct("doc_id", "hash", "start")
    least = listed.groupBy("string").agg(F.min(place).alias("least"), F.count("*").alias("n")).where("n > 1").drop("n")
    return listed.join(least, "string").where(place != F.col("least")).select("doc_id", "hash", "start", (F.col("start") + length).alias("end"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    key = text_key(F.col(id_col), F.col(text_col))
    return docs.select(
        F.coalesce(key["doc_id"], F.lit(_LAST)).alias("doc_id"), key["hash"].alias("hash"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(id_col).alias("_id")
    )


def repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans (doc_id, hash, start, end) of bytes, covered by strings that also start earlier."""
    spark = docs.sparkSession
    if length - anchor + 1 > 255:
        raise ValueError("the anchor is too short for the length")
    ship(spark)
    bounded_batches(spark)
    texts = _keyed(docs, id_col, text_col).drop("_id")
    # Only pieces whose anchor occurs twice are looked at; most texts' anchors do not.
    counts = texts.select("text").mapInArrow(_anchors(length, anchor), "anchor long, n long")
    twice = materialize(counts.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor"), "repeats-anchors")
    cut = texts.mapInArrow(_cut(length, anchor), "anchor long, content long, doc_id long, hash long, at long, gone boolean")
    known = twice.withColumn("known", F.lit(True)).hint("shuffle_hash")
    some = cut.join(known, "anchor", "left").where(F.col("gone") | F.col("known")).drop("known")
    dealt = some.repartition("anchor", "content").sortWithinPartitions("anchor", "content", "gone", "doc_id", "hash", "at")
    seen = materialize(dealt.mapInArrow(_collapse, "anchor long, doc_id long, hash long, at long, gone boolean"), "repeats-pieces")
    start = F.shiftright("at", 8)
    whole = seen.where("gone").select("doc_id", "hash", start.alias("start"), (start + F.col("at").bitwiseAND(255) - 1 + length).alias("end"))

    # Pieces that differ around one anchor may still share strings.
    left = seen.where(~F.col("gone"))
    shared = left.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    open_pieces = materialize(
        left.join(shared.hint("shuffle_hash"), "anchor").select("doc_id", "hash", "anchor", "at", (F.col("n") > MOST_PIECES).alias("many")), "repeats-open"
    )
    few = _bytes_of(texts, open_pieces.where(~F.col("many")), length).repartition("anchor").sortWithinPartitions("anchor", "doc_id", "hash", "at")
    spans = whole.union(few.mapInArrow(_index_anchors(length), "doc_id long, hash long, start long, end long"))
    many = open_pieces.where("many")
    return spans if many.isEmpty() else spans.union(_one_by_one(_bytes_of(texts, many, length), length))


def _bytes_of(texts: DataFrame, pieces: DataFrame, length: int) -> DataFrame:
    of_doc = pieces.groupBy("doc_id", "hash").agg(F.collect_list(F.struct("anchor", "at")).alias("pieces"))
    bodies = texts.join(of_doc, ["doc_id", "hash"]).dropDuplicates(["doc_id", "hash"])
    return bodies.mapInArrow(_pick(length), "anchor long, doc_id long, hash long, at long, piece binary")


def without_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, n_bytes, n_removed, n_spans, and ``kept``, the bytes that stay."""
    spans = repeats(docs, length, anchor, id_col, text_col)
    per_doc = spans.groupBy("doc_id", "hash").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = _keyed(docs, id_col, text_col).join(per_doc, ["doc_id", "hash"], "left").select("_id", "text", "spans")
    kind = joined.schema["_id"].dataType.simpleString()

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, runs, kept = [], [], [], []
            for text, found in zip(batch.column("text"), batch.column("spans")):
                body = text.as_py().encode("utf-8", "replace")
                spans = merged([(s["start"], s["end"]) for s in found.as_py() or []])
                edges = [0, *[x for s in spans for x in s], len(body)]
                kept.append(b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2])))
                sizes.append(len(body))
                removed.append(len(body) - len(kept[-1]))
                runs.append(len(spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())],
                names=[id_col, "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return joined.mapInArrow(remove, f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
