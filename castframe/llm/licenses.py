"""License scans as an exact set-similarity join, with DataFrame functions alone.

Texts are read as words and cut into overlapping blocks. A block matches a
template if it contains at least a given share of the template's distinct words.
The join finds all such pairs: the templates' words are ordered by how often they
occur in the whole corpus, rarest first, and a pair of sets can only overlap enough
if their prefixes in this order share a word. Length and position in the order rule
out more; the rest is counted exactly. Only documents with a word of some template's
prefix are cut into blocks.

Beside this, places are reported where a phrase's words stand consecutively.

Defined cases: a null text is empty and has no words. Rows alike in id and text are
answered alike. A phrase that overlaps itself is counted without overlaps. Templates
may be whole license texts: the blocks they are sought in are two to four times as long.
Very long texts are many blocks. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from castframe.llm.common import text_key
from castframe.session import materialize

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GAP = r"[\p{ASCII}&&[^\p{Alnum}]]++"  # what WORD leaves, as Java reads it
STRIDE = 32  # at least; a passage of one word more lies in one block as a whole
ASCII_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
MAX_WORDS = 100_000  # of all templates together; they are sent to every task
COARSE = (1 << 16) - 1

# The base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Opening sentences of public licenses.
TEMPLATES = [
    ("gpl", "This work is licensed under the GNU General Public License version 3"),
    ("gpl", "This program is free software you can redistribute it and or modify it under the terms of the GNU General Public License"),
    ("apache", "Licensed under the Apache License Version 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY NC 4.0"),
    ("mit", "Permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "This software is released under the MIT License"),
    ("bsd", "Redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "This source code form is subject to the terms of the Mozilla Public License"),
]


def normal(text: Column) -> Column:
    """Words with one space before, between and after them, A-Z in lower case."""
    words = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), GAP, " "))
    low = F.when(words.rlike(r"\P{ASCII}"), F.translate(words, string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.lower(words))
    return F.when(words == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), low, F.lit(" ")))


def _spaces(part: Column) -> Column:
    return (F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit("")))).cast("long")


def phrase_places(norm: Column, phrase: str) -> tuple[Column, Column, Column]:
    """How often ``phrase`` occurs in a normal text, its first and its last start."""
    n = len(phrase.split())
    parts = F.split(norm, f" {phrase}(?= )", -1)
    count = F.size(parts) - 1
    last = _spaces(norm) - 1 - (_spaces(F.element_at(parts, -1)) - 1) - n
    return count.cast("long"), F.when(count > 0, _spaces(parts[0])), F.when(count > 0, last)


def _template_words(templates: list[tuple[str, str]]) -> list[list[str]]:
    sets = [sorted(set(re.findall(WORD, text.translate(ASCII_LOWER)))) for _, text in templates]
    if sum(map(len, sets)) > MAX_WORDS:
        raise ValueError(f"the templates have more than {MAX_WORDS} words")
    return sets


def by_stride(templates: list[tuple[str, str]]) -> dict[int, list[int]]:
    """The places of the templates by the stride of their blocks, the power of two that is no less than their words."""
    found: dict[int, list[int]] = {}
    for at, (_, text) in enumerate(templates):
        words = len(re.findall(WORD, text))
        found.setdefault(max(STRIDE, 1 << (words - 1).bit_length() if words else 0), []).append(at)
    return found


def contained(docs: DataFrame, templates: list[tuple[str, str]], threshold: float, stride: int = STRIDE) -> DataFrame:
    """(key, block, template, containment) for every block and template that match.

    ``docs`` has key and norm. Block b has 2 * stride words, from b * stride on.
    """
    spark = docs.sparkSession
    sets = _template_words(templates)
    need = [math.ceil(threshold * len(s) - 1e-9) for s in sets]
    vocabulary = sorted(set().union(*sets))
    # Texts are taken apart once: the templates' own words are written with their places, and all below reads these.
    words = docs.select("key", F.posexplode(F.split(F.trim("norm"), " ")).alias("at", "word"))
    words = materialize(words.where(F.col("word").isin(vocabulary)), "licenses-words")
    counts = {r["word"]: r["count"] for r in words.groupBy("word").count().collect()}
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    ordered = [sorted(s, key=rank.__getitem__) for s in sets]
    rows = [
        (t, w, rank[w], place, len(s), need[t], place <= len(s) - need[t] + 1)
        for t, s in enumerate(ordered) for place, w in enumerate(s, 1)
    ]
    listed = F.broadcast(spark.createDataFrame(rows, "template int, word string, rank int, place int, size int, need int, in_prefix boolean"))

    # Blocks that hold a word of some prefix; the others cannot match.
    rare = sorted({w for _, w, _, _, _, _, p in rows if p})
    seeds = words.where(F.col("word").isin(rare)).select("key", F.floor(F.col("at") / stride).alias("half")).distinct()
    blocks = materialize(
        seeds.select("key", F.explode(F.array(F.col("half") - 1, F.col("half"))).alias("block")).where("block >= 0").distinct(), "licenses-blocks"
    )
    coarse = blocks.select(F.col("key.hash").bitwiseAND(F.lit(COARSE)).alias("c")).distinct()  # 65,536 rows at most
    inside = words.join(F.broadcast(coarse), F.col("key.hash").bitwiseAND(F.lit(COARSE)) == F.col("c"), "left_semi")
    half = F.floor(F.col("at") / stride)
    in_block = inside.select("key", "word", F.explode(F.array(half - 1, half)).alias("block")).distinct()
    wanted = blocks.select(F.col("key").alias("_key"), F.col("block").alias("_block"))
    sets_of = in_block.join(wanted, F.col("key").eqNullSafe(F.col("_key")) & (F.col("block") == F.col("_block")), "left_semi")
    by_rank = Window.partitionBy("key", "block").orderBy("rank")  # a block has 2 * stride words at most
    ranks = F.broadcast(spark.createDataFrame(list(rank.items()), "word string, rank int"))
    placed = materialize(
        sets_of.join(ranks, "word")
        .withColumns({"own_place": F.row_number().over(by_rank), "own_size": F.count("*").over(Window.partitionBy("key", "block"))})
        .drop("rank"),
        "licenses-sets",
    )
    met = placed.join(listed, "word")
    prefix = F.col("in_prefix") & (F.col("own_place") <= F.col("own_size") - F.col("need") + 1)
    length = F.col("own_size") >= F.col("need")
    position = 1 + F.least(F.col("own_size") - F.col("own_place"), F.col("size") - F.col("place")) >= F.col("need")
    pairs = met.where(prefix & length & position).select("key", "block", "template").distinct()
    theirs = pairs.select(F.col("key").alias("_key"), F.col("block").alias("_block"), F.col("template").alias("_template"))
    same = F.col("key").eqNullSafe(F.col("_key")) & (F.col("block") == F.col("_block")) & (F.col("template") == F.col("_template"))
    overlap = met.join(theirs, same, "left_semi").groupBy("key", "block", "template", "size", "need").count()
    return overlap.where("count >= need").select("key", "block", "template", (F.col("count") / F.col("size")).alias("containment"))


def scan(
    docs: DataFrame,
    templates: list[tuple[str, str]] | None = None,
    phrases: dict[str, str] | None = None,
    threshold: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: its words, phrase places and labels.

    ``base_labels`` come from phrases, ``labels`` from phrases and templates;
    ``score`` is the largest containment of a template, or 1 where a phrase stands.
    """
    templates = TEMPLATES if templates is None else templates
    phrases = PHRASES if phrases is None else phrases
    keyed = docs.select(F.col(id_col), text_key(F.col(id_col), F.col(text_col)).alias("key"), normal(F.col(text_col)).alias("norm"))
    matched = None
    for stride, places in by_stride(templates).items():
        part = contained(keyed.select("key", "norm"), [templates[at] for at in places], threshold, stride)
        part = part.withColumn("template", F.get(F.array(*map(F.lit, places)), F.col("template")))
        matched = part if matched is None else matched.union(part)
    if matched is None:
        matched = contained(keyed.select("key", "norm"), [], threshold)
    names = F.array(*[F.lit(label) for label, _ in templates])
    per_doc = matched.groupBy("key").agg(F.collect_set(F.get(names, F.col("template"))).alias("found"), F.max("containment").alias("best"))
    per_doc = per_doc.withColumnRenamed("key", "_key")

    places = [phrase_places(F.col("norm"), p) for p in phrases]
    none = F.lit(None).cast("long")
    rows = keyed.select(
        id_col, "key", (_spaces(F.col("norm")) - 1).alias("n_words"),
        F.array(*[F.struct(n.alias("n"), a.alias("first"), b.alias("last"), F.lit(label).alias("label")) for (n, a, b), label in zip(places, phrases.values())]).alias("p"),
    )
    rows = rows.select(
        id_col, "key", "n_words",
        F.aggregate("p", F.lit(0).cast("long"), lambda total, x: total + x["n"]).alias("n_base"),
        F.coalesce(F.array_min(F.transform("p", lambda x: x["first"])), none).alias("first_word"),
        F.coalesce(F.array_max(F.transform("p", lambda x: x["last"])), none).alias("last_word"),
        F.transform(F.filter("p", lambda x: x["n"] > 0), lambda x: x["label"]).alias("said"),
    )
    joined = rows.join(per_doc, F.col("key").eqNullSafe(F.col("_key")), "left")
    both = F.array_union("said", F.coalesce("found", F.array().cast("array<string>")))
    return joined.select(
        id_col, "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct("said")), ",").alias("base_labels"),
        F.array_join(F.array_sort(both), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
