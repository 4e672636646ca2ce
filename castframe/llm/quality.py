"""A quality classifier: a generalised additive model with pairwise interactions.

Texts are described by ``FEATURES``, each cut into at most ``BINS`` bins at quantiles of
the training rows. The log odds of label 1 are the sum of one table entry per feature and
one per chosen pair of features. The tables are learned by cyclic boosting: in every
round each feature in turn adds a shallow tree over its bins, of ``LEAVES`` leaves, that
takes a small Newton step on the logistic loss. Then the pairs of features with the
strongest interaction left in the residuals get tables of their own, over coarser bins,
in the same way. Scoring looks bins up and adds table entries, for a batch at once.

At most ``max_rows`` labelled rows are drawn for training, by a hash of their ids; their
features alone go to the driver, so the training takes bounded memory however large the
corpus is. Scoring reads every text once and shuffles nothing.

Defined cases: a null text is scored as an empty one. Rows without id, and labels that
are null or neither 0 nor 1, are not learned from; a row with several labels is learned
from once with each. Training rows that are few or of one label give a model of few or no
tables, with the share of label 1 as its score; without any the score is 0.5. Repeated
rows have equal scores. An empty table gives no rows. A task holds the words of one text
at a time, however long it is. Columns that are not named are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from castframe.llm.common import bounded_batches
from castframe.session import ship

MAX_ROWS = 20_000  # labelled rows that are learned from
BINS, COARSE_BINS = 32, 8  # of a feature; of a feature in a pair
LEAVES = 3
ROUNDS, RATE = 150, 0.1
PAIRS, PAIR_ROUNDS = 8, 60
LEAST_ROWS = 5  # in a leaf
SHRINK = 1.0  # added to the curvature of a leaf

_GROUPS = {
    "letters": [*range(65, 91), *range(97, 123), *range(128, 256)], "upper": [*range(65, 91)], "digits": [*range(48, 58)],
    "spaces": [9, 10, 11, 12, 13, 32], "stops": list(b".,;:?"), "shouts": list(b"!"), "bars": list(b"|"),
    "marks": list(b"#$%&*@^~=+<>{}[]\\/_`"), "quotes": list(b"\"'()-"),
}
_MEMBERS = np.zeros((256, len(_GROUPS)))
for _at, _codes in enumerate(_GROUPS.values()):
    _MEMBERS[_codes, _at] = 1

FEATURES = (
    "length", *_GROUPS, "entropy", "words", "word_length", "longest_word", "distinct_words", "commonest_word", "short_words",
    "marked_words", "distinct_pairs", "lines", "line_length", "distinct_lines", "ended_lines",
)


def features_of(text: bytes | None) -> list[float]:
    """The ``FEATURES`` of a UTF-8 text."""
    text = text or b""
    codes = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size = max(1, len(text))
    shares = codes / size
    present = shares[shares > 0]
    words = text.split()
    n = max(1, len(words))
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    lines = [line for line in text.split(b"\n") if line.strip()]
    groups = shares @ _MEMBERS
    groups[1] = codes[65:91].sum() / max(1, codes[65:91].sum() + codes[97:123].sum())
    return [
        np.log1p(len(text)), *groups, float(-(present * np.log2(present)).sum()), np.log1p(len(words)), lengths.mean(), np.log1p(lengths.max()),
        len(counts) / n, max(counts.values(), default=0) / n, (lengths <= 3).mean(), sum(not w[-1:].isalnum() and w[-1] < 128 for w in words) / n,
        len(set(zip(words, words[1:]))) / max(1, len(words) - 1), np.log1p(len(lines)), np.log1p(len(text) / max(1, len(lines))),
        len(set(lines)) / max(1, len(lines)), sum(line.rstrip()[-1:] in b".!?" for line in lines) / max(1, len(lines)),
    ]


def feature_rows(texts: pa.Array) -> np.ndarray:
    rows = [features_of(t.as_py()) for t in texts]
    return np.array(rows, np.float64).reshape(len(rows), len(FEATURES))


class Model(NamedTuple):
    """Log odds: ``bias`` and the entries of the tables for the bins of a row."""

    bias: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: dict[tuple[int, int], np.ndarray]

    def odds(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.bias)
        for column, edges, table in zip(rows.T, self.edges, self.tables):
            total += table[_binned(column, edges)]
        bins = {f: _binned(rows[:, f], self.coarse[f]) for pair in self.pairs for f in pair}
        for (f, g), table in self.pairs.items():
            total += table[bins[f], bins[g]]
        return total

    def score(self, rows: np.ndarray) -> np.ndarray:
        return _chance(self.odds(rows))


def _chance(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def _binned(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.searchsorted(edges, values, side="right")


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _sums(bins: np.ndarray, size: int, gradient: np.ndarray, curvature: np.ndarray) -> np.ndarray:
    """Rows, gradient and curvature by bin, as three rows."""
    return np.stack([np.bincount(bins, w, size) for w in (np.ones(len(bins)), gradient, curvature)])


def _best_cut(sums: np.ndarray) -> tuple[float, int]:
    """The gain of the best cut of consecutive bins into two leaves, and how many of them go left."""
    left = np.cumsum(sums, axis=1)[:, :-1]
    right = sums.sum(axis=1)[:, None] - left
    whole = sums[1].sum() ** 2 / (sums[2].sum() + SHRINK)
    gain = left[1] ** 2 / (left[2] + SHRINK) + right[1] ** 2 / (right[2] + SHRINK) - whole
    gain[(left[0] < LEAST_ROWS) | (right[0] < LEAST_ROWS)] = 0
    return (float(gain.max()), int(gain.argmax()) + 1) if gain.size else (0.0, 0)


def _tree(sums: np.ndarray) -> np.ndarray:
    """A step per bin: a tree of up to ``LEAVES`` leaves that is grown at its best cut each time."""
    leaves = [(0, sums.shape[1])]
    while len(leaves) < LEAVES:
        found = [(*_best_cut(sums[:, a:b]), a, b) for a, b in leaves]
        gain, cut, a, b = max(found)
        if gain <= 1e-9:
            break
        leaves.remove((a, b))
        leaves += [(a, a + cut), (a + cut, b)]
    step = np.zeros(sums.shape[1])
    for a, b in leaves:
        step[a:b] = sums[1, a:b].sum() / (sums[2, a:b].sum() + SHRINK)
    return step


def _grid_tree(sums: np.ndarray) -> tuple[float, np.ndarray]:
    """The gain and the step per cell of a grid: one cut, along the better axis, and on either side one along the other axis."""
    best = 0.0, np.zeros(sums.shape[1:])
    for axis in (0, 1):
        grid = sums if axis == 0 else sums.transpose(0, 2, 1)
        for cut in range(1, grid.shape[1]):
            gain, step = 0.0, np.zeros(grid.shape[1:])
            for a, b in ((0, cut), (cut, grid.shape[1])):
                side = grid[:, a:b].sum(axis=1)
                if side[0].sum() < LEAST_ROWS:
                    break
                _, at = _best_cut(side)
                for c, d in ((0, at), (at, grid.shape[2])):
                    g, h = side[1, c:d].sum(), side[2, c:d].sum() + SHRINK
                    gain += g * g / h
                    step[a:b, c:d] = g / h
            else:
                if gain > best[0]:
                    best = gain, step if axis == 0 else step.T
    whole = sums[1].sum() ** 2 / (sums[2].sum() + SHRINK)
    return best[0] - whole, best[1]


def fit(rows: np.ndarray, labels: np.ndarray) -> Model:
    """The tables from feature rows and labels 0 or 1."""
    width = rows.shape[1]
    if not len(labels) or labels.min() == labels.max():
        bias = 0.0 if not len(labels) else float(np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1)))
        none = [np.empty(0)] * width
        return Model(bias, none, [np.zeros(1)] * width, none, {})
    share = labels.mean()
    bias = float(np.log(share / (1 - share)))
    edges = [_cuts(column, BINS) for column in rows.T]
    bins = [_binned(column, cut) for column, cut in zip(rows.T, edges)]
    tables = [np.zeros(len(cut) + 1) for cut in edges]
    odds = np.full(len(labels), bias)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        chance = _chance(odds)
        return labels - chance, chance * (1 - chance)

    for _ in range(ROUNDS):
        for f, own in enumerate(bins):
            step = RATE * _tree(_sums(own, len(tables[f]), *slopes()))
            tables[f] += step
            odds += step[own]

    coarse = [_cuts(column, COARSE_BINS) for column in rows.T]
    places = [_binned(column, cut) for column, cut in zip(rows.T, coarse)]

    def grid(f: int, g: int) -> tuple[np.ndarray, np.ndarray]:
        shape = len(coarse[f]) + 1, len(coarse[g]) + 1
        return _sums(places[f] * shape[1] + places[g], shape[0] * shape[1], *slopes()).reshape(3, *shape), places[f] * shape[1] + places[g]

    strength = {(f, g): _grid_tree(grid(f, g)[0])[0] for f, g in combinations(range(width), 2)}
    chosen = sorted((p for p in strength if strength[p] > 0), key=lambda p: (-strength[p], p))[:PAIRS]
    pairs = {p: np.zeros((len(coarse[p[0]]) + 1, len(coarse[p[1]]) + 1)) for p in chosen}
    for _ in range(PAIR_ROUNDS):
        for p in chosen:
            sums, cells = grid(*p)
            step = RATE * _grid_tree(sums)[1]
            pairs[p] += step
            odds += step.ravel()[cells]
    return Model(bias, edges, tables, coarse, pairs)


def _with_features(run: Callable[[pa.RecordBatch, np.ndarray], list], names: list[str]) -> Callable:
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(run(batch, feature_rows(batch.column("_text"))), names=names)

    return mapped


def train(docs: DataFrame, labels: DataFrame, usable: Column, label_col: str = "quality", max_rows: int = MAX_ROWS) -> Model:
    """A model from ``labels`` (doc_id and ``label_col``) for which ``usable``, over doc_id, holds."""
    ship(docs.sparkSession)
    bounded_batches(docs.sparkSession)
    known = labels.where(usable & F.col("doc_id").isNotNull() & F.col(label_col).isin(0, 1)).select("doc_id", F.col(label_col).cast("int").alias("label"))
    drawn = known.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_rows)  # the bound of the broadcast
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("_text")).join(F.broadcast(drawn), "doc_id").select("doc_id", "_text", "label")
    vector = _with_features(
        lambda batch, rows: [batch.column("doc_id"), batch.column("label"), pa.array(list(rows), pa.list_(pa.float64()))], ["doc_id", "label", "features"]
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    # Ids may repeat, so the limit holds for the rows too; the order makes the sums of training repeatable.
    found = texts.mapInArrow(vector, f"doc_id {kind}, label int, features array<double>")
    found = found.orderBy(F.xxhash64("doc_id"), "doc_id", "label", "features").limit(max_rows).toArrow()
    rows = np.array(found.column("features").to_pylist(), np.float64).reshape(found.num_rows, len(FEATURES))
    return fit(rows, found.column("label").to_numpy().astype(np.float64))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``doc_id`` and the ``score`` of each row, between 0 and 1."""
    spark = docs.sparkSession
    ship(spark)
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    scored = _with_features(lambda batch, rows: [batch.column("doc_id"), pa.array(shared.value.score(rows), pa.float64())], ["doc_id", "score"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col(text_col).cast("binary").alias("_text")).mapInArrow(scored, f"doc_id {kind}, score double")
