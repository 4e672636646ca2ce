"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram of letters is the product
of its letters' vectors, rotated by their place; a text is the sum of its
trigrams, a language the sum of its texts' directions. A text is given the
language whose prototype has the largest cosine with it.

Defined cases: a text that is null, empty or without letters is ``und`` with
score 0, as is every text if no labelled text has letters. Equal cosines go to
the language first in order. Null ``lang`` and null ids are not learned from.
Repeated rows are answered alike; further columns pass through, except those
named like the new ones, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from castframe.llm.common import bounded_batches, packed, slices, whole_row
from castframe.session import ship

UND = "und"
_SLICE = 128 << 10
_MAX_CACHED = 16_384  # vectors of trigrams, a byte for each sign
_BLOCK = 2048  # trigrams whose vectors are in use at once


class Encoder:
    """Texts to vectors. Keeps the vectors of letters and of recent trigrams."""

    def __init__(self, dims: int, seed: int):
        self.dims, self.seed = dims, seed
        self.place = np.full(0x110000, -1, np.int32)  # code point -> letter number; 0 is no letter
        self.points = [0]
        self.letters = np.ones((1, dims), np.int8)  # what stands beside a word has the unit vector
        self.keys = np.empty(0, np.int64)
        self.rows = np.empty(0, np.int64)  # of the keys, in grams
        self.grams = np.empty((_MAX_CACHED, dims), np.int8)

    def _learn(self, points: np.ndarray) -> None:
        rows = [self.letters]
        for point in points.tolist():
            if chr(point).isalpha():
                self.place[point] = len(self.points)
                self.points.append(point)
                rows.append(np.random.default_rng([self.seed, point]).integers(0, 2, (1, self.dims), np.int8) * 2 - 1)
            else:
                self.place[point] = 0
        self.letters = np.concatenate(rows)

    def _vectors(self, keys: np.ndarray) -> np.ndarray:
        """One row for each of the sorted distinct keys, ``_BLOCK`` at most."""
        new = np.setdiff1d(keys, self.keys, assume_unique=True)
        if len(self.keys) + len(new) > _MAX_CACHED:
            self.keys, self.rows, new = self.keys[:0], self.rows[:0], keys
        if len(new):
            mask, held = (1 << 21) - 1, len(self.keys)
            bound = np.roll(self.letters[new >> 42], 2, axis=1)
            bound *= np.roll(self.letters[(new >> 21) & mask], 1, axis=1)
            self.grams[held : held + len(new)] = bound * self.letters[new & mask]
            joined, rows = np.concatenate([self.keys, new]), np.concatenate([self.rows, held + np.arange(len(new))])
            order = np.argsort(joined)
            self.keys, self.rows = joined[order], rows[order]
        return self.grams[self.rows[np.searchsorted(self.keys, keys)]].astype(np.float32)

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        """One bundled vector per text; zeros without letters."""
        out = np.zeros((len(texts), self.dims), np.float32)
        lowered = [(t or "").lower() for t in texts]
        sizes = np.array([len(t) + 1 for t in lowered])
        points = np.frombuffer((" " + " ".join(lowered) + " ").encode("utf-32-le", "replace"), np.uint32)
        code = self.place[points]
        if (code < 0).any():
            self._learn(np.unique(points[code < 0]))
            code = self.place[points]
        mid = np.flatnonzero(code[1:-1]) + 1  # trigrams around a letter: none spans two words
        if not len(mid):
            return out
        wide = code.astype(np.int64)
        keys, which = np.unique((wide[mid - 1] << 42) | (wide[mid] << 21) | wide[mid + 1], return_inverse=True)
        owner = np.searchsorted(np.cumsum(sizes), mid - 1, side="right")
        counts = np.bincount(owner * len(keys) + which, minlength=len(texts) * len(keys))
        counts = counts.reshape(len(texts), len(keys)).astype(np.float32)
        for at in range(0, len(keys), _BLOCK):
            out += counts[:, at : at + _BLOCK] @ self._vectors(keys[at : at + _BLOCK])
        return out


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-30)


def held_out(doc_id: Column) -> Column:
    """One document in five, by its id; a null id counts as one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    dims: int = 1024, seed: int = 7, max_texts: int = 8000, max_languages: int = 1000,
) -> dict[str, np.ndarray]:
    """Prototypes by language, from about ``max_texts`` labelled texts of each at most.

    The sample is drawn by a hash of the id. More than ``max_languages`` labels
    are an error: the prototypes are sent to every task.
    """
    spark = docs.sparkSession
    ship(spark)
    bounded_batches(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(~held_out(F.col("id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(max_languages + 1).collect()}
    if len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    if not sizes:
        return {}
    shares = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, max_texts / n))])
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / (1 << 30)
    sample = rows.where(draw < F.element_at(shares, F.col("lang"))).select("text", "lang")

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, sums = Encoder(dims, seed), {}
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                units = _unit(encode(part.column("text").to_pylist())).astype(np.float64)
                langs = np.array(part.column("lang").to_pylist())
                for lang in set(langs.tolist()):
                    sums[lang] = sums.get(lang, 0) + units[langs == lang].sum(axis=0)
        for lang, total in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": [lang] * dims, "at": pa.array(range(dims), pa.int32()), "x": total})

    summed = sample.mapInArrow(bundle, "lang string, at int, x double").groupBy("lang", "at").agg(F.sum("x").alias("x"))
    found: dict[str, np.ndarray] = {}
    for r in summed.collect():  # languages x dims numbers, both bounded
        found.setdefault(r["lang"], np.zeros(dims))[r["at"]] = r["x"]
    return {lang: v.astype(np.float32) for lang, v in sorted(found.items()) if np.linalg.norm(v) > 0}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text", dims: int = 1024, seed: int = 7) -> DataFrame:
    """Add ``lang_pred`` and ``score``, the cosine (0 if negative)."""
    spark = docs.sparkSession
    ship(spark)
    bounded_batches(spark)
    rows, schema = packed(docs, text_col, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()))
    names = [*sorted(prototypes), UND]
    ranked = _unit(np.stack([prototypes[x] for x in names[:-1]])) if prototypes else np.zeros((1, dims), np.float32)
    model = spark.sparkContext.broadcast(ranked)  # max_languages x dims at most

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(dims, seed)
        for batch in batches:
            for part in slices(batch, "_text", _SLICE):
                vectors = encode(part.column("_text").to_pylist())
                cosines = _unit(vectors) @ model.value.T
                best = cosines.argmax(axis=1)
                blank = ~vectors.any(axis=1) | (len(names) == 1)
                langs = [UND if none else names[i] for i, none in zip(best.tolist(), blank.tolist())]
                scores = np.where(blank, 0.0, np.clip(cosines[np.arange(len(best)), best], 0, 1)).astype(np.float64)
                yield pa.RecordBatch.from_arrays([part.column("_row"), pa.array(langs, pa.string()), pa.array(scores)], names=schema.names)

    return rows.mapInArrow(label, schema).select("_row.*", "lang_pred", "score")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **settings) -> DataFrame:
    """Learn from the labelled texts that are not held out, then label every text."""
    fitted = train(docs, id_col, text_col, lang_col, **settings)
    return predict(docs, fitted, text_col, **{k: v for k, v in settings.items() if k in ("dims", "seed")})


def reject_unknown(docs: DataFrame, min_score: float = 0.1, min_short: float = 0.03, letters: int = 64) -> DataFrame:
    """Leave out texts without letters and those far from every learned language.

    The cosine of unrelated vectors has a spread of 1/32, whatever the length: texts in
    unlearned scripts reach 0.09. Texts of ``letters`` letters or more in a learned
    language lie far above; they need ``min_score``. The cosines of shorter ones do not
    tell noise from language, so these need ``min_short`` only.
    """
    labelled = identify(docs.select("doc_id", "text", "lang", whole_row(docs).alias("_row")))
    long = F.col("text").rlike(rf"(?s)(?:\p{{L}}\P{{L}}*+){{{letters}}}")
    least = F.when(long, F.lit(min_score)).otherwise(F.lit(min_short))
    return labelled.where((F.col("lang_pred") != UND) & (F.col("score") >= least)).select("_row.*")
