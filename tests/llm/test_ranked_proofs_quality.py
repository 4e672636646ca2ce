"""The Merkle manifest, ranked search and the quality classifier, against brute force and on odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from make import ENGLISH, documents, odd, plain
from pyspark.sql import functions as F

from castframe.llm import langid, lexical, manifest, quality
from castframe.llm.queries import QUERIES


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, odd(plain())).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return documents(spark, [])


# -- manifest --


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def slow_tree(leaves):
    """The top, and for each leaf its (left, right) siblings."""
    now, under, ways = list(leaves), [[i] for i in range(len(leaves))], [[] for _ in leaves]
    while len(now) > 1:
        above, owners = [], []
        for i in range(0, len(now), 2):
            pair = now[i : i + 2]
            for j, inner in enumerate(under[i : i + 2]):
                for leaf in inner:
                    ways[leaf].append((pair[0] if j else "", "" if j or len(pair) == 1 else pair[1]))
            above.append(digest("".join(pair)))
            owners.append(sum(under[i : i + 2], []))
        now, under = above, owners
    return now[0], ways


def slow_manifest(rows):
    """(doc_id, leaf, subroot, root, siblings) of rows with the fields in order."""
    trees = {}
    for row in rows:
        leaf = digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))
        trees.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf, row[0]))
    order = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    tops = {}
    for lang in order:
        trees[lang].sort(key=lambda x: x[:3])
        tops[lang] = slow_tree([x[2] for x in trees[lang]])
    root, last = slow_tree([tops[lang][0] for lang in order])
    return [
        (x[3], x[2], tops[lang][0], root, tuple(way + more))
        for lang, more in zip(order, last) for x, way in zip(trees[lang], tops[lang][1])
    ]


def proofs_of(frame):
    rows = frame.select("doc_id", *[manifest.shown(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")], "siblings").collect()
    return [(r[0], r[1], r[2], r[3], tuple((s["left"].hex(), s["right"].hex()) for s in r["siblings"])) for r in rows]


@pytest.mark.parametrize("step, limit", [(8, 32 << 20), (2, 32 << 20), (1, 0)])
def test_proofs_equal_brute_force(docs, monkeypatch, step, limit):
    monkeypatch.setattr(manifest, "STEP", step)
    monkeypatch.setattr(manifest, "BROADCAST_BYTES", limit)
    rows = [tuple(r) for r in docs.select(*manifest.FIELDS).collect()]
    assert sorted(proofs_of(manifest.manifest(docs)), key=repr) == sorted(slow_manifest(rows), key=repr)


def test_a_deep_tree_of_one_language(spark):
    rows = [(i, f"text {i}", "en", "s") for i in range(700)] + [(i, "x", f"lang{i}", None) for i in range(5)]
    frame = documents(spark, rows)
    plain_rows = [tuple(r) for r in frame.select(*manifest.FIELDS).collect()]
    assert sorted(proofs_of(manifest.manifest(frame)), key=repr) == sorted(slow_manifest(plain_rows), key=repr)


def test_only_true_leaves_lead_to_the_root(docs):
    fields = {c: F.col(c) for c in manifest.FIELDS}
    other = manifest.leaf_digest(fields | {"text": F.concat("text", F.lit("."))})
    proofs = manifest.manifest(docs, {"claimed": other}).select(
        (manifest.folded(F.col("leaf"), F.col("siblings")) == F.col("root")).alias("true"),
        (manifest.folded(F.col("claimed"), F.col("siblings")) == F.col("root")).alias("false"), (F.col("claimed") == F.col("leaf")).alias("same"),
    ).collect()
    assert all(r["true"] for r in proofs) and all(r["false"] == r["same"] for r in proofs)
    assert sum(r["same"] for r in proofs) == 2  # the null texts


def test_tampering_is_found(spark, sf_dir):
    out = QUERIES["op12_merkle_manifest"](spark, sf_dir).collect()
    assert {r["verified"] for r in out} == {True, False}
    for r in out:
        assert r["verified"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 != 0) and r["verified"] == (r["folded_root"] == r["root"])


def test_manifest_of_nothing_and_of_one(spark, empty):
    assert manifest.manifest(empty).count() == 0
    one = manifest.manifest(documents(spark, [(1, "a", None, None)])).first()
    assert one["leaf"] == one["subroot"] == one["root"] and one["siblings"] == []


# -- ranked search --


def slow_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def slow_search(rows, items, k=10):
    counts = [(i, Counter(slow_terms(t))) for i, t in rows]
    counts = [(i, c) for i, c in counts if c]
    n, total = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in set(items):
        asked = Counter(slow_terms(text))
        scores = []
        for doc, c in counts:
            m = 100 - 75 + 75 * c.total() * n // total
            score = sum(r * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, r in asked.items() if c[t])
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, place + 1, s[3], -s[0]) for place, s in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "item_id string, text string, key string, term string")


def asked(rows):
    draw = random.Random(3)
    own = [(f"q{i}", " ".join(draw.choices(slow_terms(draw.choice(rows)[1]) or ["none"], k=12)).upper()) for i in range(25)]
    return [*own, ("q0", own[1][1]), own[2], ("empty", ""), (None, own[3][1]), ("nothing", None), ("absent", "zzzzzz qqqqqq"), ("long", " ".join(ENGLISH * 300))]


@pytest.mark.parametrize("small", [False, True])
def test_search_equals_brute_force(spark, docs, monkeypatch, small):
    if small:  # several blocks of queries, and portions that must be followed by others
        for name, value in (("BLOCK_TERMS", 40), ("FIRST", 1), ("MORE", 2), ("SPREAD", 1), ("LEAST_WIDTH", 1), ("HELD_TERMS", 3)):
            monkeypatch.setattr(lexical, name, value)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    items = asked([r for r in rows if r[1]])
    k = 3 if small else 10
    got = sorted([tuple(r) for r in lexical.search(docs, items_of(spark, items), k).collect()], key=repr)
    assert got == slow_search(rows, items, k)


def test_search_of_nothing(spark, docs, empty):
    columns = ["item_id", "rank", "doc_id", "score"]
    for some in (lexical.search(empty, items_of(spark, [("a", "the of")])), lexical.search(docs, items_of(spark, [])), lexical.search(docs, items_of(spark, [("a", "...")]))):
        assert some.columns == columns and some.count() == 0


def test_bounds_are_never_below():
    draw = random.Random(1)
    corpus = lexical.Corpus(100, 20_000)
    for size in (1, 5, 60, 900):
        counts = {f"t{draw.randrange(10**6)}".encode(): draw.choice([1, 1, 2, 7, 254, 255, 300, 5000]) for _ in range(size)}
        hashes = lexical._hashes(list(counts))
        made = lexical.sketch(hashes, np.array(list(counts.values())))
        assert len(made) & (len(made) - 1) == 0 and len(made) >= min(size * lexical.SPREAD, lexical.LEAST_WIDTH)
        bound = lexical.bounds_on_counts(made, hashes)
        n = sum(counts.values())
        shares = lexical._shares(n, corpus)
        for c, b in zip(counts.values(), bound.tolist()):
            assert b >= min(c, 255) and shares[b] >= 10**9 * c // (1000 * c + 8 * lexical._norm(n, corpus))


def test_a_large_group_of_copies(spark):
    rows = [(i, "alpha beta gamma delta", "en", "s") for i in range(300)] + [(1000 + i, f"alpha word{i} beta", "en", "s") for i in range(50)]
    got = lexical.search(documents(spark, rows), items_of(spark, [("a", "beta gamma")])).collect()
    assert [(r["rank"], r["doc_id"]) for r in sorted(got)] == [(i + 1, i) for i in range(10)]


# -- quality --


def test_held_out_labels_are_met(spark):
    found = QUERIES["op13_quality"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    rows = found.where("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 50
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.97 * len(rows)
    bad, good = ([r["score"] for r in rows if r["quality"] == q] for q in (0, 1))
    assert sum(b < g for b in bad for g in good) >= 0.98 * len(bad) * len(good)


def test_interactions_are_learned():
    draw = np.random.default_rng(1)
    rows = draw.random((3000, len(quality.FEATURES)))
    labels = ((rows[:, 2] > 0.5) ^ (rows[:, 5] > 0.5)).astype(float)
    model = quality.fit(rows[:2000], labels[:2000])
    assert (2, 5) in model.pairs
    assert ((model.score(rows[2000:]) > 0.5) == labels[2000:]).mean() > 0.97
    alone = model._replace(pairs={})
    assert ((alone.score(rows[2000:]) > 0.5) == labels[2000:]).mean() < 0.6


def test_scoring_adds_table_entries():
    draw = np.random.default_rng(2)
    rows = draw.random((400, len(quality.FEATURES)))
    model = quality.fit(rows, (rows[:, 1] + rows[:, 4] * rows[:, 7] > 0.7).astype(float))
    for row, score in zip(rows[:50], model.score(rows[:50])):
        odds = model.bias + sum(t[sum(e <= x for e in edge)] for x, edge, t in zip(row, model.edges, model.tables))
        odds += sum(t[sum(e <= row[f] for e in model.coarse[f]), sum(e <= row[g] for e in model.coarse[g])] for (f, g), t in model.pairs.items())
        assert math.isclose(score, 1 / (1 + math.exp(-odds)), rel_tol=1e-9)


def test_models_of_few_rows():
    none = np.empty((0, len(quality.FEATURES)))
    some = np.array([quality.features_of(t) for t in (b"a b", b"c", None)])
    assert quality.fit(none, np.empty(0)).score(some).tolist() == [0.5] * 3
    assert quality.fit(some, np.ones(3)).score(some).tolist() == [0.8] * 3


def test_quality_on_odd_rows(spark, docs, empty):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(None, 1, 0), (3, None, 0), (4, 7, 0), (5, 0, 1)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels, ~langid.held_out(F.col("doc_id")))
    out = quality.score(docs, model).collect()
    texts = {(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()}
    assert len(out) == docs.count() and len(texts) < len(out) and all(0 <= r.score <= 1 for r in out)
    score = {r.doc_id: r.score for r in out}
    assert score[1001] == score[1002]  # null and empty
    assert score[1000] == score[1]  # a copy
    again = quality.score(docs, quality.train(docs, labels, ~langid.held_out(F.col("doc_id")))).collect()
    assert sorted(out, key=repr) == sorted(again, key=repr)
    assert quality.score(empty, model).count() == 0
    assert quality.score(docs, quality.train(docs, labels.limit(0), F.lit(True))).select("score").distinct().collect() == [(0.5,)]


def test_training_takes_no_more_rows_than_it_says(spark, docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    seen = []
    fit = quality.fit
    quality.fit = lambda rows, y: seen.append(len(y)) or fit(rows, y)
    try:
        quality.train(docs, labels, F.lit(True), max_rows=10)
    finally:
        quality.fit = fit
    assert seen == [10]
