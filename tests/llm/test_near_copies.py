"""The pipeline's near copies of whole documents, against brute force on five-word shingles."""

import random

from make import ENGLISH, documents, odd, plain, sentence
from test_text_operators import roots

from castframe.llm import linededup, simhash


def shingles(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def changed(seed=8):
    """Documents of some lines, and for each a copy with one to eight words changed."""
    draw = random.Random(seed)
    out = []
    for i in range(120):
        words = sentence(draw, ENGLISH, 150).split()
        copy = list(words)
        for at in draw.sample(range(len(words)), draw.randint(1, 8)):
            copy[at] = f"other{draw.randrange(10**6)}"
        for k, own in ((0, words), (1000, copy)):
            out.append((i + k, "\n".join(" ".join(own[at : at + 25]) for at in range(0, len(own), 25)), "en", "s"))
    return out


def one_boilerplate(seed=9):
    """Documents that share most shingles but not enough, each with a near copy."""
    draw = random.Random(seed)
    body = sentence(draw, ENGLISH, 200).split()
    out = []
    for i in range(60):
        own = " ".join([*body, *(f"own{i}w{n}" for n in range(30))])
        out += [(5000 + i, own, "en", "s"), (6000 + i, own + f" tail{i}", "en", "s")]
    return out


def test_near_copies_of_documents(spark):
    for some in (changed(), one_boilerplate(), [r for r in odd(plain()) if r[0] is not None and r[0] not in (2, 1006, 1007)]):
        sets = {(i, t or ""): shingles(t) for i, t, *_ in some}
        names = sorted(sets)
        linked = [(a, b) for n, a in enumerate(names) for b in names[n + 1 :] if jaccard(sets[a], sets[b]) >= 0.8]
        expected = {i for i, _ in set(roots(names, linked).values())}
        assert len(expected) < len(names)
        kept = simhash.keep_first(documents(spark, some)).collect()
        assert sorted(r.doc_id for r in kept) == sorted(expected)


def with_other_lines(seed=12):
    """Documents of 30 lines, for each a copy with two lines of its own, and one with most of its lines from elsewhere."""
    draw = random.Random(seed)
    out = []
    for i in range(40):
        lines = [" ".join(f"{draw.choice(ENGLISH)}{draw.randrange(1000)}" for _ in range(10)) for _ in range(30)]
        for k, own in ((1000, 2), (2000, 18)):
            copy = list(lines)
            for at in draw.sample(range(30), own):
                copy[at] = " ".join(f"{draw.choice(ENGLISH)}{draw.randrange(1000)}" for _ in range(10))
            out.append((i + k, "\n".join(copy), "en", "s"))
        out.append((i, "\n".join(lines), "en", "s"))
    return out


def test_near_copies_are_not_torn_before_they_are_judged(spark):
    frame = documents(spark, with_other_lines())
    lines = linededup.dedup_lines(frame, torn=0.5).cache()
    texts = {r.doc_id: r.text for r in frame.collect()}
    left = {r.doc_id: r for r in lines.collect()}
    for i in range(40):
        assert left[i].text == texts[i] and left[1000 + i].text == texts[1000 + i]  # 28 of 30 lines would go
        assert len(left[2000 + i].text.split("\n")) == 18 and left[2000 + i].n_chars == len(left[2000 + i].text)
    kept = {r.doc_id for r in simhash.keep_first(lines).collect()}
    assert kept == {*range(40), *range(2000, 2040)}
    assert {r.doc_id for r in simhash.keep_first(linededup.dedup_lines(frame)).collect()} > kept  # torn ones pass as clean
