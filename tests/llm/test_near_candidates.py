"""The candidates of the pipeline's near copies come from SimHash fingerprints."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from test_near_copies import changed, documents

from castframe.llm import linededup, simhash


def test_candidates_are_simhash_groups(spark, monkeypatch):
    monkeypatch.delattr(linededup, "banded")  # the minima of the line dedup
    kept = {r.doc_id for r in simhash.keep_first(documents(spark, changed())).collect()}
    assert {*range(120)} <= kept and len(kept) < 200


def test_similar_sets_share_a_group_and_others_none(spark):
    draw = np.random.default_rng(3)
    rows = []
    for i in range(300):
        n = 9 * (1 + i % 20)
        one = draw.integers(-(2**63), 2**63 - 1, n)
        other = np.concatenate([one[: n * 8 // 9], draw.integers(-(2**63), 2**63 - 1, n - n * 8 // 9)])  # 0.8
        rows += [(2 * i, 0, one.tolist()), (2 * i + 1, 0, other.tolist())]
    sets = spark.createDataFrame(rows, "l1 long, l2 long, s array<long>")
    bands = simhash.near_bands(sets).select("l1", F.explode("bands").alias("band"))
    met = bands.groupBy("band").agg(F.collect_set(F.floor(F.col("l1") / 2)).alias("pairs"), F.count("*").alias("n")).where("n > 1").collect()
    found = {p for r in met for p in r.pairs}
    assert len(found) >= 297 and sum(len(r.pairs) > 1 for r in met) <= 3


def test_lists_across_batches_and_long_lists():
    near = np.array([[5, 9]] * 200 + [[~5, ~9]], np.int64)
    far = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, (300, 2))
    rows = [(1, i, 0, *x) for i, x in enumerate(near.tolist())] + [(2, i, 0, *x) for i, x in enumerate(far.tolist())] + [(3, i, 0, 1, 1) for i in (7, 8)]
    for size in (1, 7, 200, 201, 1000):
        parts = [rows[at : at + size] for at in range(0, len(rows), size)]
        batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*p)], names=["list", "l1", "l2", "x", "y"]) for p in parts]
        got = sorted(tuple(r.values()) for b in simhash._grouped(iter(batches)) for r in b.to_pylist())
        assert got == sorted([(i, 0, 1, 0) for i in range(200)] + [(i, 0, 3, 7) for i in (7, 8)])
