"""Benchmark decontamination with a generalised suffix automaton over words.

The automaton holds every run of words of the benchmark items. A document's words
are streamed through it; at each word it gives the longest run ending there that
some item contains. Wherever that run has the length of a window, or is a whole
item shorter than one, its words are hit.

The automaton is sent to every task, so its size is bounded: items are dealt into
blocks of at most ``block_words`` words (or one item), and documents pass one
block after the other, with their hits kept in a written table in between.

Defined cases: a null or empty text has no words; an item without words has no
window; a null item_id is the id ``null``; rows with one item_id are windows of one
item. Extra columns pass through, except those named like the new ones, which are
replaced. Repeated rows are answered alike. Without items nothing is hit.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from castframe.llm.common import bounded_batches, changed_rows, packed, whole_row
from castframe.session import materialize, ship

_WORDS = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))
_FOLD = bytes(ord(chr(b).lower()) if b in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" else b if b in _WORDS else 0x20 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_FOLD).split()


class Automaton:
    """A generalised suffix automaton of word sequences."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.length, self.link = [0], [-1]
        sequences = []
        for name, words in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            sequences.append((name, ids))
            last = 0
            for x in ids:
                last = self._extend(last, x)
        self.names = [name for name, _ in sequences]
        self.least = min([window, *(len(ids) for _, ids in sequences if ids)])
        # The state of the window that ends where a state's run ends.
        self.window_state = [self._ancestor(s) for s in range(len(self.length))]
        self.items_of: dict[int, set[int]] = {}
        self.short: dict[int, list[tuple[int, int]]] = {}
        ends: dict[int, list[tuple[int, int]]] = {}
        for item, (_, ids) in enumerate(sequences):
            state = 0
            for at, x in enumerate(ids, 1):
                state = self.next[state][x]
                if at >= window:
                    self.items_of.setdefault(self.window_state[state], set()).add(item)
            if 0 < len(ids) < window:
                ends.setdefault(state, []).append((len(ids), item))
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__) if ends else []:
            found = self.short.get(self.link[state], []) + ends.get(state, [])
            if found:
                self.short[state] = found

    def _ancestor(self, state: int) -> int:
        while state > 0 and self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def _copy(self, p: int, x: int, q: int) -> int:
        """Split ``q``: its runs of up to length[p] + 1 words get a state of their own."""
        made = len(self.length)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = made
        while p >= 0 and self.next[p].get(x) == q:
            self.next[p][x] = made
            p = self.link[p]
        return made

    def _extend(self, last: int, x: int) -> int:
        p, known = last, self.next[last].get(x)
        if known is not None:
            return known if self.length[known] == self.length[p] + 1 else self._copy(p, x, known)
        made = len(self.length)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        while p >= 0 and x not in self.next[p]:
            self.next[p][x] = made
            p = self.link[p]
        if p >= 0:
            q = self.next[p][x]
            self.link[made] = q if self.length[q] == self.length[p] + 1 else self._copy(p, x, q)
        return made

    def stream(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """The hit runs of ``words`` as (start, end), merged, and the items that occur."""
        get = self.vocabulary.get
        ids = np.array([get(w, -1) for w in words], np.int64)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (ids >= 0).astype(np.int8), [0]])))
        spans: list[tuple[int, int]] = []
        states: set[int] = set()
        items: set[int] = set()
        window, follow, link, length, short = self.window, self.next, self.link, self.length, self.short
        # Runs of known words that are too short for any window cannot be hit.
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - start < self.least:
                continue
            state = matched = 0
            for at, x in enumerate(ids[start:end].tolist(), start + 1):
                to = follow[state].get(x)
                while to is None and state:
                    state = link[state]
                    matched = length[state]
                    to = follow[state].get(x)
                if to is None:
                    continue
                state, matched = to, matched + 1
                if matched >= window:
                    spans.append((at - window, at))
                    states.add(state)
                if short and state in short:
                    for size, item in short[state]:
                        if size <= matched:
                            spans.append((at - size, at))
                            items.add(item)
        for state in {self.window_state[s] for s in states}:
            items |= self.items_of[state]
        return merged(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    held, size = [], 0
    for row in benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")), "text").toLocalIterator():
        words = words_of(row[1])
        if held and size + len(words) > block_words:
            yield held
            held, size = [], 0
        held.append((row[0], words))
        size += len(words)
    yield held


_FOUND = [
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_spans", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("hit_items", T.ArrayType(T.StringType())),
]


def find(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_words: int = 200_000, text_col: str = "text") -> DataFrame:
    """Add n_words, hit_spans (word ranges, end exclusive) and hit_items (sorted ids)."""
    spark = docs.sparkSession
    ship(spark)
    bounded_batches(spark)
    now, schema = packed(docs, text_col, *_FOUND)
    schema = T.StructType([now.schema["_text"], *schema])
    automaton = None
    for turn, items in enumerate(_blocks(benchmark, block_words)):
        if automaton is not None:
            now = materialize(now, f"decontaminate{turn}")
        automaton = spark.sparkContext.broadcast(Automaton(items, window))  # block_words words or one item
        now = now.mapInArrow(_scan(automaton, bool(turn)), schema)
    return now.select("_row.*", *[f.name for f in _FOUND])


def _scan(automaton, again: bool) -> Callable:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, all_spans, all_items = [], [], []
            for row, text in enumerate(batch.column("_text")):
                words = words_of(text.as_py())
                spans, items = automaton.value.stream(words)
                names = {automaton.value.names[i] for i in items}
                if again:
                    spans = merged(spans + [tuple(x) for x in batch.column("hit_spans")[row].as_py()])
                    names |= set(batch.column("hit_items")[row].as_py())
                n_words.append(len(words))
                all_spans.append([list(x) for x in spans])
                all_items.append(sorted(names))
            new = [pa.array(n_words, pa.int64()), pa.array(all_spans, pa.list_(pa.list_(pa.int64()))), pa.array(all_items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column("_text"), batch.column("_row"), *new], names=["_text", "_row", *(f.name for f in _FOUND)])

    return scan


def n_hit() -> Column:
    return F.aggregate("hit_spans", F.lit(0).cast("long"), lambda total, s: total + s[1] - s[0])


def clean(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, max_coverage: float = 0.5, block_words: int = 200_000
) -> DataFrame:
    """The rows of ``docs`` without the words of hit spans and the text between them.

    A row of whose words more than ``max_coverage`` are hit goes as a whole. Texts
    without a hit stay as they are. ``n_chars``, where present, follows the text.
    """
    found = find(docs.select("text", whole_row(docs).alias("_row")), benchmark, window, block_words)
    ship(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column("hit_spans").to_pylist()
            if any(spans):
                texts = [without(t, s) if s else t for t, s in zip(batch.column("text").to_pylist(), spans)]
                batch = batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))
            yield batch.select(["_row", "text"])

    kept = found.where(n_hit() <= F.lit(max_coverage) * F.col("n_words")).select("_row", "text", "hit_spans")
    texts = kept.mapInArrow(cut, T.StructType([kept.schema["_row"], kept.schema["text"]]))
    return changed_rows(texts, F.col("text"), F.col("text").eqNullSafe(F.col("_row.text")))


def without(text: str, spans: list[list[int]]) -> str:
    """``text`` without the words in ``spans``, one space in place of each run."""
    places = [m.span() for m in _WORD.finditer(text)]
    parts, at = [], 0
    for start, end in spans:
        parts.append(text[at : places[start][0]].rstrip(" "))
        at = places[end - 1][1]
    return " ".join(p for p in [*parts, text[at:].lstrip(" ")] if p)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document: counts, and the digest of the sorted item ids."""
    return found.select(
        id_col, "n_words", n_hit().alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"), (F.size("hit_items") > 0).alias("contaminated"),
    )

