"""Documents for tests, among them the odd ones."""

from __future__ import annotations

import random

EXTRA = ["key", "_key", "_row", "fp", "first", "score", "lang_pred", "removed", "n_words", "hit_spans", "epoch", "block", "spans", "norm", "found", "a.b"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in EXTRA)

ENGLISH = "the of and to in that was with for his they which from have this but not are all one were there when would what".split()
GERMAN = "der die und das nicht mit sich auch dem den auf ein von ist des wird eine als werden wenn haben über nach".split()


def sentence(draw: random.Random, words: list[str], n: int) -> str:
    return " ".join(draw.choice(words) + draw.choice(words) if draw.random() < 0.5 else draw.choice(words) for _ in range(n))


def plain(n: int = 60, seed: int = 1) -> list[tuple]:
    """(doc_id, text, lang, source)"""
    draw = random.Random(seed)
    out = []
    for i in range(n):
        lang = "en" if i % 2 else "de"
        lines = [sentence(draw, ENGLISH if i % 2 else GERMAN, draw.randint(8, 30)) for _ in range(draw.randint(1, 6))]
        out.append((i, "\n".join(lines), lang, f"src{i % 3 and i % 5}"))
    return out


def odd(rows: list[tuple]) -> list[tuple]:
    """The given rows, copies of some, and rows with nulls, blanks, odd signs and a very long text."""
    draw = random.Random(5)
    return [
        *rows, rows[0], rows[0], (1000, rows[1][1], "de", None), (rows[2][0], rows[3][1], "en", "src0"),
        (None, rows[4][1], "en", "src1"), (None, None, None, None), (1001, None, "en", "src1"), (1002, "", "en", "src0"),
        (1003, " \n\t\n", None, "src2"), (1004, "12345 !!! ---", "en", "src2"), (1005, "语言模型的训练数据\nÀÉÎ ßü İstanbul K", None, "src3"),
        (1006, sentence(draw, ENGLISH, 60_000), "en", "src0"), (1007, "x" * 300_000, None, "src1"), (1008, "a b", "en", "src0"),
    ]


def documents(spark, rows: list[tuple]):
    """A documents table with further columns, whose names operators might use themselves."""
    full = [(i, t, lang, source, None if t is None else len(t), *["x"] * len(EXTRA)) for i, t, lang, source in rows]
    return spark.createDataFrame(full, SCHEMA)
