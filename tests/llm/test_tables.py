"""Queries against SQL; secret rules, licenses, neighbours and mixing on odd rows; the pipeline."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from compare import difference
from make import documents, odd, plain
from pyspark.sql import functions as F

import corpus_pipeline
from castframe.llm import ann, licenses, mixing, secretscan
from castframe.llm.oracle import ORACLE
from castframe.llm.queries import QUERIES

PYTHON_NODES = re.compile("Python|Pandas|Arrow")


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, odd(plain())).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return documents(spark, [])


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), sf_dir, ORACLE[name]) is None


@pytest.mark.parametrize("name", ["op2_line_dedup", "op4_secret_scan", "op10_license_scan"])
def test_native_queries_run_no_python(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not PYTHON_NODES.search(plan)


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if re.match(r"op\d+_", n)) == list(range(1, 14))


# -- secrets --


def test_trigram_queries():
    assert secretscan.trigram_query("[0-9a-f]{16,}") is True
    assert secretscan.trigram_query("abcd") == ("and", ("abc", "bcd"))
    assert secretscan.trigram_query("(abc|xyz)+") == ("or", ("abc", "xyz"))
    assert secretscan.trigram_query("(abc)?[0-9]") is True
    assert secretscan.trigram_query("a[bc]d\\d+efg") == ("and", (("or", ("abd", "acd")), "efg")) or set(
        secretscan.trigrams_of(secretscan.trigram_query("a[bc]d\\d+efg"))
    ) == {"abd", "acd", "efg"}


@pytest.mark.parametrize("rule", secretscan.BASE + secretscan.MORE, ids=lambda r: r.kind)
def test_every_match_satisfies_its_query(rule):
    examples = {
        "assign": ["API_KEY = 'abcdefghijkl'", "apikey:abcdefghijkl", 'Password"  :  "abc+/=_.-xyz12', "secret=aaaaaaaaaaaa", "PASSWD=123456789012", "token: abcdefghijklm"],
        "access": ["AKIAABCDEFGHIJ2345"], "hex": ["0123456789abcdef"], "pem": ["-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN PRIVATE KEY-----"],
        "github": ["ghp_" + "a1" * 18], "slack": ["xoxb-123456789012"], "google": ["AIza" + "b" * 35], "jwt": ["eyJabcdefgh1.eyJabcdefgh2.abcdefgh-_"],
    }[rule.kind]

    def holds(query, text):
        if query is True or isinstance(query, str):
            return query is True or query in text.lower()
        return (all if query[0] == "and" else any)(holds(q, text) for q in query[1])

    for text in examples:
        assert re.search(rule.pattern, text) and holds(secretscan.trigram_query(rule.pattern), text)


def slow_base(text):
    text = text or ""
    assign = r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, "assign", m.end()) for m in re.finditer(assign, text, re.I | re.A) if len(m[2]) >= 12]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 16]
    return sorted(found)


def test_secrets(spark, empty):
    texts = [
        "é password: secret:abcdefghijklmnopq", "password=token=abcdefghijklmnop", "AKIAAKIA" + "A" * 12 + " AKIA1 AKIA" + "B" * 14, "a" * 15 + " " + "b" * 16,
        "token='" + "0" * 32 + "' 😀 API_KEY = \"" + "f" * 20, "passwordpassword=abcdefghijkl", "", None, "secret = ", ("api-key apikey=" + "z9" * 8 + "\n") * 500,
        "PassWD:::abcdefghijkl", "ghp_" + "aZ" * 18,
    ]
    rows = [*odd(plain(10)), *[(100 + i, t, "en", "s") for i, t in enumerate(texts)], (100, texts[0], "en", "s"), (None, texts[1], "en", "s")]
    kinds = {"assign", "access", "hex"}
    got = secretscan.scan(documents(spark, rows)).collect()
    mine = Counter((r.doc_id, tuple((m.start, m.place, m.kind, m.end) for m in r.found if m.kind in kinds)) for r in got)
    assert mine == Counter((i, tuple(slow_base(t))) for i, t, *_ in rows)
    assert [m.kind for r in got if r.doc_id == 111 for m in r.found] == ["github"]
    assert secretscan.scan(empty).count() == 0


# -- licenses --


def test_licenses_against_all_blocks(spark, empty):
    draw = random.Random(4)
    templates = [("x", "red green blue yellow black"), ("y", "one two three four"), ("z", "blue blue white")]
    vocabulary = "red green blue yellow black one two three four white and or".split()
    rows = [(100 + i, " ".join(draw.choice(vocabulary) if draw.random() < 0.2 else "filler" for _ in range(draw.randint(0, 300))), "en", "s") for i in range(60)]
    rows += [*odd(plain(6)), (900, "MIT License mit-license", "en", "s"), (900, "MIT License mit-license", "en", "s")]
    got = licenses.scan(documents(spark, rows), templates=templates, threshold=0.75).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    by_id = {r.doc_id: r for r in got}
    for i, text, *_ in rows[:60]:
        words = text.split()
        blocks = [set(words[b : b + 64]) for b in range(0, max(len(words), 1), 32)]
        best = {label: max(len(set(t.split()) & b) / len(set(t.split())) for b in blocks) for label, t in templates}
        labels = sorted(x for x, share in best.items() if share >= 0.75)
        assert by_id[i].labels == ",".join(labels)
        assert by_id[i].score == pytest.approx(max([best[x] for x in labels], default=0))
    r = by_id[900]
    assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (4, 2, 0, 2, "mit")
    assert by_id[1001].n_words == 0 and by_id[1001].first_word is None
    assert licenses.scan(empty).count() == 0


def test_whole_license_texts_are_found_wherever_they_stand(spark):
    body = " ".join(f"term{i}" for i in range(150))
    templates = [("long", body), ("short", "red green blue yellow black")]
    words = body.split()
    changed = " ".join(w for i, w in enumerate(words) if i % 6)  # five words of six are left
    rows = [(i, " ".join([*["filler"] * (7 * i), changed if i % 2 else body, *["filler"] * 50]), "en", "s") for i in range(60)]
    rows += [(100 + i, " ".join([*["filler"] * i, "red green blue yellow black", "filler"]), "en", "s") for i in range(40)]
    rows += [(200, " ".join(words[:100]), "en", "s")]
    got = {r.doc_id: r for r in licenses.scan(documents(spark, rows), templates=templates).collect()}
    for i in range(60):
        assert got[i].labels == "long" and got[i].score == pytest.approx(125 / 150 if i % 2 else 1)
    assert {got[100 + i].labels for i in range(40)} == {"short"}
    assert (got[200].labels, got[200].score) == ("", 0)


def test_only_a_to_z_are_lowered(spark):
    rows = [(1, "\u212aey ONE two", "en", "s"), (2, "KEY one TWO", "en", "s")]
    got = {r.doc_id: r.labels for r in licenses.scan(documents(spark, rows), templates=[("k", "key one two")], threshold=1.0).collect()}
    assert got == {1: "", 2: "k"}


def test_words_are_counted_by_the_contract(spark):
    texts = ["", None, " a-b_c ", "\u00e9t\u00e9 42,\u4e2d\u6587 \U0001f600x", "--", "z", "\u00a0\u2003x", "a\x00b\x7fc", *[chr(i) * 2 + "q" for i in range(1, 256)]]
    made = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    for r in made.select("text", mixing.word_count(F.col("text")).alias("n"), licenses.normal(F.col("text")).alias("norm")).collect():
        words = re.findall(licenses.WORD, r.text or "")
        assert (r.n, r.norm.split(" ")[1:-1]) == (len(words), [w.translate(licenses.ASCII_LOWER) for w in words])


# -- neighbours --


def slow_nearest(rows, k):
    units = {i: np.array(v, np.float64) / np.linalg.norm(v) for i, v in rows}
    out = {}
    for i, u in units.items():
        near = sorted((-(u @ w), j) for j, w in units.items() if j != i and len(w) == len(u))
        out[i] = near[:k]
    return out


def test_neighbours_and_odd_vectors(spark):
    draw = np.random.default_rng(6)
    rows = [(i, draw.normal(size=8).astype(np.float32).tolist()) for i in range(600)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)]  # many equal vectors
    odd_rows = [(2000, None), (2001, []), (2002, [0.0] * 8), (2003, [1.0, None] * 4), (2004, [float("nan")] * 8), (2005, [float("inf")] + [1.0] * 7), (None, rows[5][1]), rows[0], (2006, [1.0, 2.0])]
    table = spark.createDataFrame([(i, v, "x", "y") for i, v in rows + odd_rows], "vec_id long, embedding array<float>, dim string, shard string")
    vectors = ann.vectors_of(table)
    got = {}
    for r in ann.nearest(vectors, vectors, k=5, shard_rows=100).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    expected = slow_nearest(rows, 5)
    assert set(got) == set(expected)  # 2006 has no candidates
    hits = sum(a <= expected[i][-1][0] + 1e-9 for i in expected for a, _ in got[i])
    assert hits >= 0.97 * 5 * len(expected)
    assert [j for _, j in got[3]] == [1000, 1001, 1002, 1003, 1004] and [j for _, j in got[1002]][:2] == [3, 1000]
    assert ann.nearest(vectors.limit(0), vectors.limit(0)).count() == 0
    pair = vectors.where("id < 2")
    assert [(r.query_id, r.vec_id) for r in ann.nearest(pair, pair).orderBy("query_id").collect()] == [(0, 1), (1, 0)]


def test_every_node_of_a_graph_can_be_reached():
    draw = np.random.default_rng(1)
    tight = np.concatenate([draw.normal(size=16) * 10 + draw.normal(size=(200, 16)) * 0.01 for _ in range(5)]).astype(np.float32)
    graph = ann.build([[i] for i in range(len(tight))], tight, 3)
    found, _ = ann.search(graph, 16, tight, 32)
    order = [x[0] for x in graph["ids"]]
    assert np.mean([i in {order[n] for n in f} for i, f in enumerate(found)]) > 0.97


# -- mixing --


def test_repetition_limit(spark, docs):
    got = mixing.mix(docs, max_repeats=2.0).collect()
    tokens, order = Counter(), {}
    for i, t, _, source in odd(plain()):
        tokens[source] += len(re.findall(mixing.WORD, t or ""))
    taken = Counter()
    for r in got:
        taken[r.source] += r.n_tokens
        order.setdefault((r.source, r.epoch), []).append(r)
    most = max(tokens.values())
    repeats = {s: taken[s] / n for s, n in tokens.items() if n}
    assert max(r.epoch for r in got) <= 1 and repeats[max(tokens, key=tokens.get)] == 1
    assert Counter(r.doc_id for r in got if r.epoch == 0) == Counter(i for i, *_ in odd(plain()))
    ratio = most / min(n for n in tokens.values() if n)
    exponent = 1 - math.log(2) / math.log(ratio)
    for s, n in tokens.items():
        if n:
            wanted = (most / n) ** (1 - exponent) * n
            longest = max(r.n_tokens for r in got if r.source == s)
            assert wanted - 1 <= taken[s] <= wanted + longest + 1 or taken[s] == 2 * n
    for rows in order.values():  # places follow on one another
        rows = sorted((r.start_token, r.n_tokens) for r in rows if r.n_tokens)
        assert all(a + n <= b for (a, n), (b, _) in zip(rows, rows[1:])) or len({r for r in rows}) < len(rows)


def test_entropy_target(spark):
    rows = spark.createDataFrame([("a", 800, 1), ("b", 150, 1), ("c", 50, 1), ("d", 0, 1)], "source string, tokens long, docs long")
    for target in (0.7, 0.9, 1.05):
        a = mixing.exponent_for_entropy(rows, target)
        w = np.array([0.8, 0.15, 0.05]) ** a
        w /= w.sum()
        assert -(w * np.log(w)).sum() == pytest.approx(target, abs=1e-9)
    assert mixing.exponent_for_entropy(rows, 0.1) == 1 and mixing.exponent_for_entropy(rows, 2.0) == pytest.approx(0, abs=1e-12)
    given = {r.source: r for r in mixing.weights(rows, 0.5, budget=1000).collect()}
    assert sum(r.weight for r in given.values()) == pytest.approx(1) and given["d"].weight == 0
    assert given["c"].whole * 50 + given["c"].rest == pytest.approx(1000 * given["c"].weight, abs=1)


def test_mixing_nothing(empty):
    assert mixing.mix(empty).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(empty, max_repeats=2.0, entropy=1.0)


# -- the pipeline --


def test_pipeline_stages(spark, sf_dir):
    now = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = {r[0] for r in now.select("doc_id").collect()}
    columns = now.columns
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, sf_dir).cache()
        left = {r[0] for r in now.select("doc_id").collect()}
        assert left <= ids and left, name
        ids = left
        if name != corpus_pipeline.STAGES[-1][0]:
            assert now.columns == columns
    whole = corpus_pipeline.run(spark, sf_dir)
    assert Counter(map(tuple, whole.collect())) == Counter(map(tuple, now.collect()))


def test_pipeline_on_odd_rows(spark, sf_dir, docs, empty):
    for start in (docs, empty):
        now = start
        for _, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, sf_dir)
        now.agg(F.count("*")).collect()
