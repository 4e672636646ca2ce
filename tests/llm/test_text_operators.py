"""Language ID, SimHash, decontamination, token counts, repeats, lines: against brute force and on odd rows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from make import EXTRA, documents, odd, plain, sentence, ENGLISH
from pyspark.sql import functions as F

from castframe.llm import decontaminate, langid, linededup, runindex, simhash, tokencounts
from castframe.llm.common import components

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def rows():
    return odd(plain())


@pytest.fixture(scope="module")
def docs(spark, rows):
    return documents(spark, rows).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return documents(spark, [])


def roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# -- components --


def test_components_of_chains_stars_and_nothing(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(1000, 1300)]
    made = components(spark.createDataFrame([*chain, *star, (5, 5), (3, 4), (4, 3)], "a long, b long"), "test")
    expected = roots({x for e in [*chain, *star, (3, 4)] for x in e}, [*chain, *star, (3, 4)])
    assert {r.node: r.root for r in made.collect()} == expected
    assert components(spark.createDataFrame([], "a long, b long"), "none").count() == 0


# -- language ID --


def test_languages_of_held_out_texts(docs, rows):
    got = langid.identify(docs, dims=512).select("doc_id", "lang", "lang_pred", "score", *[f"`{c}`" for c in EXTRA if c not in ("lang_pred", "score")]).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.score <= 1 for r in got)
    clear = [r for r in got if r.lang and r.doc_id is not None and r.doc_id < 1000]
    assert sum(r.lang == r.lang_pred for r in clear) >= 0.95 * len(clear)
    for r in got:
        if r.doc_id in (1001, 1002, 1003, 1004):
            assert (r.lang_pred, r.score) == ("und", 0)


def test_language_of_a_text_does_not_depend_on_its_neighbours():
    texts = [t for _, t, *_ in plain(20)] + [None, "", "x1y"]
    together = langid.Encoder(256, 3)(texts)
    alone = np.concatenate([langid.Encoder(256, 3)([t]) for t in texts])
    assert np.array_equal(together, alone)
    # One word by the definition: the product of rotated letters, for three trigrams.
    coder = langid.Encoder(256, 3)
    got = coder(["Ab"])[0]
    a, b = (coder.letters[coder.place[ord(c)]].astype(int) for c in "ab")
    assert np.array_equal(got, np.roll(a, 1) * b + np.roll(a, 2) * np.roll(b, 1))


def test_no_labels_means_undetermined(spark, empty):
    got = langid.identify(documents(spark, [(1, "some words", None, "s")])).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]
    assert langid.identify(empty).count() == 0
    with pytest.raises(ValueError):
        langid.train(documents(spark, [(i, "word", f"l{i}", "s") for i in range(30)]), max_languages=3)


def test_rejecting_keeps_rows_as_they_are(docs, rows):
    kept = langid.reject_unknown(docs)
    assert kept.columns == docs.columns
    assert {r[0] for r in kept.select("doc_id").collect()} >= {i for i, *_ in rows if i is not None and i < 1000}
    assert not {r[0] for r in kept.select("doc_id").collect()} & {1001, 1002, 1003, 1004}


def test_scripts_of_no_language_go_and_clean_texts_stay(spark, rows):
    draw = random.Random(3)
    script = [chr(0x10D0 + i) for i in range(33)] + [" "] * 6
    noise = [(5000 + i, "".join(draw.choice(script) for _ in range(draw.choice([120, 500, 3000]))), None, "s") for i in range(60)]
    short = [(6000 + i, sentence(draw, ENGLISH, n), None, "s") for i, n in enumerate([1, 2, 3, 5, 8, 13, 21, 34] * 4)]
    kept = {r[0] for r in langid.reject_unknown(documents(spark, [*rows, *noise, *short])).select("doc_id").collect()}
    assert not kept & {i for i, *_ in noise}
    assert kept >= {i for i, t, *_ in short if len(t.split()) >= 5}


# -- SimHash --


def slow_fingerprint(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("words", [3, 5])
def test_fingerprints(rows, words):
    for _, text, *_ in rows:
        if len(text or "") < 20_000:
            assert simhash.fingerprint_of(text, words) % (1 << 64) == slow_fingerprint(text, words)


def near_prints(seed, centres=4, around=400):
    draw = random.Random(seed)
    out = [draw.getrandbits(64) for _ in range(200)]
    for _ in range(centres):
        centre = draw.getrandbits(64)
        for _ in range(around):
            x = centre
            for bit in draw.sample(range(64), draw.randint(0, 5)):
                x ^= 1 << bit
            out.append(x)
    return sorted(set(out))


@pytest.mark.parametrize("longest", [512, 20])
def test_links_connect_all_within_three_bits(spark, monkeypatch, longest):
    monkeypatch.setattr(simhash, "LONGEST_LIST", longest)  # short lists send dense groups to the finer blocks
    prints = np.array(near_prints(2), np.uint64)
    expected = roots(
        prints.view(np.int64).tolist(),
        [(int(a), int(b)) for i, a in enumerate(prints.view(np.int64)) for b in prints.view(np.int64)[i + 1 :][np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= 3]],
    )
    frame = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp long")
    edges = [(r.a, r.b) for r in simhash.links(frame).collect()]
    assert all(bin((a ^ b) & (2**64 - 1)).count("1") <= 3 for a, b in edges)
    assert roots(expected, edges) == expected


def test_near_duplicates_of_odd_rows(spark, docs, rows, empty):
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"))
    got = simhash.near_duplicates(docs, key, words=3).collect()
    assert len(got) == len(rows)
    first = {r.key.doc_id: r["first"].doc_id for r in got}
    assert first[1000] == 1  # an exact copy
    assert first[1001] == first[1002] == first[1003] == 1001  # no words
    assert simhash.near_duplicates(empty, key).count() == 0


def test_one_of_each_group_stays(docs, rows):
    kept = simhash.keep_first(docs).collect()
    ids = Counter(r.doc_id for r in kept)
    assert ids[0] == 1 and 1000 not in ids and ids[1001] == 1 and 1002 not in ids
    assert set(range(60)) - {3} <= set(ids)  # 3 has the text of another row with id 2


# -- decontamination --


def slow_contamination(text, items, window=10):
    words, hit, names = WORD.findall(lower(text)), set(), set()
    for name, item in items:
        own = WORD.findall(lower(item))
        n = min(window, len(own))
        runs = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i : i + n]) in runs:
                hit |= set(range(i, i + n))
                names.add("null" if name is None else str(name))
    return len(words), len(hit), sorted(names)


def contaminated_rows(rows):
    passage = rows[5][1].split("\n")[0]
    items = [
        (1, passage), (2, passage + " extra words here"), (2, "alpha beta"), (3, None), (4, ""), (None, "gamma DELTA epsilon"),
        (10, "alpha"), (11, "beta alpha beta"), (12, " ".join(["echo"] * 12)), (13, "one two three four five six seven eight nine ten eleven"),
    ]
    more = [
        (2001, f"before {passage.upper()} after", "en", "s"), (2002, "alpha,beta; alpha... gamma-delta epsilon", "en", "s"),
        (2003, " ".join(["echo"] * 30), "en", "s"), (2004, "zero one two three four five six seven eight nine TEN end", "en", "s"), (2005, "alpha beta " * 2000, "en", "s"),
    ]
    return [*rows, *more], items


@pytest.mark.parametrize("block_words", [200_000, 12])
def test_contamination(spark, rows, block_words):
    every, items = contaminated_rows(rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find(documents(spark, every), bench, block_words=block_words).collect()
    expected = Counter((i, n, h, tuple(names)) for (i, t, *_), (n, h, names) in zip(every, [slow_contamination(t, items) for _, t, *_ in every]))
    assert Counter((r.doc_id, r.n_words, sum(b - a for a, b in r.hit_spans), tuple(r.hit_items)) for r in got) == expected


@pytest.mark.parametrize("seed", range(20))
def test_automaton_on_few_words(seed):
    draw = random.Random(seed)
    items = [(str(i), [draw.choice([b"a", b"b", b"c"]) for _ in range(draw.randint(0, 9))]) for i in range(6)]
    made = decontaminate.Automaton(items, 4)
    text = [draw.choice([b"a", b"b", b"c", b"d"]) for _ in range(60)]
    spans, found = made.stream(text)
    _, n, names = slow_contamination(b" ".join(text).decode(), [(name, b" ".join(w).decode()) for name, w in items], 4)
    assert (sum(b - a for a, b in spans), sorted(made.names[i] for i in found)) == (n, names)


def test_cleaning_takes_out_passages(spark, rows, empty):
    every, items = contaminated_rows(rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(spark, every)
    cleaned = decontaminate.clean(docs, bench)
    assert cleaned.columns == docs.columns
    left = {r.doc_id: r for r in cleaned.collect()}
    assert 2005 not in left and left[6].text == rows[6][1]
    long = " ".join(f"own{i}" for i in range(40))
    one = decontaminate.clean(documents(spark, [(1, f"{long}, {rows[5][1].splitlines()[0]}. {long}", "en", "s")]), bench).first()
    assert one.text == f"{long}, . {long}" and one.n_chars == len(one.text)
    assert decontaminate.clean(empty, bench).count() == 0
    assert decontaminate.find(docs, bench.limit(0)).agg(F.sum(F.size("hit_items"))).first()[0] == 0


# -- token counts --


def test_token_histogram(spark, docs, rows, empty):
    from tokenizers import Tokenizer

    other = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    other.encode_special_tokens = True
    sizes = sorted(len(x.ids) for x in other.encode_batch([t or "" for _, t, *_ in rows], add_special_tokens=False))
    hist = tokencounts.histogram(tokencounts.lengths(docs)).cache()
    assert sorted((r.n_tokens, r.n_docs) for r in hist.collect()) == sorted(Counter(sizes).items())
    for r in hist.collect():
        more = [s for s in sizes if s >= r.n_tokens]
        assert (r.docs_at_least, r.tokens_at_least) == (len(more), sum(more))
        assert r.tokens_if_truncated == sum(min(s, r.n_tokens) for s in sizes)
        assert r.docs_at_most == sum(s <= r.n_tokens for s in sizes)
    limits = [0, 1, 100, 10**9]
    assert tokencounts.truncated_totals(hist, limits) == [sum(min(s, x) for s in sizes) for x in limits]
    assert tokencounts.quantiles(hist, [0.5, 1.0]) == [sizes[-(-len(sizes) // 2) - 1], sizes[-1]]
    none = tokencounts.histogram(tokencounts.lengths(empty))
    assert tokencounts.quantiles(none, [0.5]) == [None] and tokencounts.truncated_totals(none, [5]) == [0]


# -- repeats --


def slow_repeats(rows, length):
    """By (doc_id, text): bytes, removed, runs, kept."""
    order = sorted({(r[0] is None, r[0] or 0, r[1]) for r in rows if r[1]}, key=lambda x: (x[0], x[1]))
    seen, out = set(), {}
    for none, doc, text in order:
        body = text.encode()
        gone = bytearray(len(body))
        for i in range(len(body) - length + 1):
            s = body[i : i + length]
            if s in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(s)
        kept = bytes(b for b, g in zip(body, gone) if not g)
        out[None if none else doc, text] = (len(body), sum(gone), len(re.findall(b"\1+", bytes(gone))), kept)
    return out


def repeated_rows(rows):
    draw = random.Random(9)
    passage = sentence(draw, ENGLISH, 40)
    with_passage = [(3000 + i, f"{sentence(draw, ENGLISH, 12)} {passage[i % 7 : 150 + i % 5]} {sentence(draw, ENGLISH, 12)}", "en", "s") for i in range(40)]
    loops = [(4000, "ab" * 400, "en", "s"), (4001, "xab" * 200, "en", "s"), (4002, "é" * 500, "en", "s"), (4003, passage[:99], "en", "s"), (4004, passage[:100], "en", "s")]
    # One id with several texts is ordered by a hash; brute force has no such order.
    return [r for r in rows if r[0] is not None and r[0] != 2 and len(r[1] or "") < 50_000] + with_passage + loops


@pytest.mark.parametrize("most, text", [(32_768, 1 << 20), (3, 500)])
def test_repeated_bytes(spark, rows, monkeypatch, most, text):
    monkeypatch.setattr(runindex, "MOST_PIECES", most)
    monkeypatch.setattr(runindex, "TEXT", text)
    some = repeated_rows(rows)
    expected = slow_repeats(some, 100)
    got = runindex.without_repeats(documents(spark, some)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in some)
    texts = {r[0]: r[1] for r in some}
    for r in got:
        want = expected.get((r.doc_id, texts[r.doc_id]), (0, 0, 0, b""))
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == want


def test_repeats_of_odd_rows(spark, docs, rows, empty):
    got = runindex.without_repeats(docs).collect()
    assert len(got) == len(rows)
    assert next(r for r in got if r.doc_id == 1007).n_removed == 300_000 - 1  # all but the first byte's string
    assert runindex.without_repeats(empty).count() == 0


def test_texts_longer_than_a_slice(spark, monkeypatch):
    monkeypatch.setattr(runindex, "SLICE", 1000)
    some = [r for r in plain(12) if len(r[1]) > 300]
    some += [(500 + i, a[1] + b[1], "en", "s") for i, (a, b) in enumerate(zip(some, some[1:]))]
    expected = slow_repeats(some, 100)
    texts = {r[0]: r[1] for r in some}
    for r in runindex.without_repeats(documents(spark, some)).collect():
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == expected[r.doc_id, texts[r.doc_id]]


@pytest.mark.parametrize("seed", range(10))
def test_run_index_has_true_matches(seed):
    draw = random.Random(seed)
    texts = [bytes(draw.choice(b"ab") for _ in range(draw.randint(5, 60))) for _ in range(20)]
    data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    suffixes = sorted((t[i:], e - len(t) + i) for t, e in zip(texts, ends.tolist()) for i in range(len(t)))
    index = runindex.RunIndex(data, ends)
    at = np.array(sorted(p for _, p in suffixes))
    size, neighbour = index.matching(at)
    before = {b: a for (_, a), (_, b) in zip(suffixes, suffixes[1:])}
    body = {p: s for s, p in suffixes}
    for p, n, q in zip(at.tolist(), size.tolist(), neighbour.tolist()):
        if p in before:
            assert q == before[p]
            assert n == next((i for i, (x, y) in enumerate(zip(body[p], body[q])) if x != y), min(len(body[p]), len(body[q])))
    assert len(index.run_starts) <= len(data)


# -- lines --


def shingles(line):
    """The runs of five characters, one from every character."""
    return {line[i : i + 5] for i in range(len(line) - 4)} or {line}


def slow_lines(rows, threshold=0.8):
    places, lines = {}, {}
    for i, t, *_ in rows:
        for n, line in enumerate((t or "").split("\n")) if t is not None else []:
            line = re.sub(r"^[ \t\n\x0b\f\r]+|[ \t\n\x0b\f\r]+$", "", line)
            if line:
                lines.setdefault(line, set()).add((i is None, i or 0, n))
    sets = {s: shingles(s) for s in lines}
    names = sorted(lines)
    linked = [
        (a, b) for i, a in enumerate(names) for b in names[i + 1 :]
        if len(a) < 5000 and len(b) < 5000 and (k := len(sets[a] & sets[b])) >= threshold * (len(sets[a]) + len(sets[b]) - k)
    ]
    root = roots(names, linked)
    groups = {}
    for s, at in lines.items():
        groups.setdefault(root[s], set()).update(at)
    gone = set().union(*[g - {min(g)} for g in groups.values()])
    for none, i, n in gone:
        places.setdefault(None if none else i, []).append(n)
    return {i: sorted(n) for i, n in places.items()}


def line_rows(rows):
    draw = random.Random(3)
    base = sentence(draw, ENGLISH, 40).split()
    variants = []
    for i in range(60):  # one line with many near copies
        words = list(base)
        words[draw.randrange(40)] = f"word{i}"
        variants.append((5000 + i, sentence(draw, ENGLISH, 20) + "\n" + " ".join(words) + "\n\n  the same short line ", "en", "s"))
    return [r for r in rows if r[0] is None or r[0] not in (2, 1006, 1007)] + variants


def test_lines(spark, rows):
    some = line_rows(rows)
    expected = slow_lines(some)
    got = linededup.report(documents(spark, some)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in some)
    assert {r.doc_id: r.removed_lines for r in got if r.n_removed} == expected
    assert all(r.n_removed == len(r.removed_lines) for r in got)


def test_deduplicated_documents(spark, docs, rows, empty):
    kept = linededup.dedup_lines(docs)
    assert kept.columns == docs.columns
    left = {r.doc_id: r for r in kept.collect()}
    assert left[0].text == rows[0][1] and 1000 not in left and left[1001].text is None and left[1003].text == " \n\t\n"
    for r in left.values():
        assert r.n_chars == (None if r.text is None else len(r.text))
    assert linededup.dedup_lines(empty).count() == 0 and linededup.report(empty).count() == 0


def test_digest_of_no_items(spark, docs):
    found = decontaminate.digest(decontaminate.find(docs, spark.createDataFrame([], "item_id long, text string")))
    assert {r.items_sha256 for r in found.collect()} == {hashlib.sha256(b"").hexdigest()}
