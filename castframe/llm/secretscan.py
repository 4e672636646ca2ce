"""Secret scans over a trigram index, with DataFrame functions alone.

Each rule's regular expression gives a Boolean query over trigrams that every
match must contain. An inverted index lists the documents by trigram; a rule's
postings are intersected and united as its query says, and only the documents
that remain are searched with the expression itself. Rules without mandatory
trigrams search every text.

Defined cases: a null text is empty; documents without a span have zero counts,
an empty span list and its digest. Rows alike in id and text are answered alike.
Matches of one rule never overlap; matches of several may. Extra columns are not
read. An empty table gives no rows.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from castframe.llm.common import text_key
from castframe.session import materialize

MAX_STRINGS = 64  # a regular expression's piece with more spellings counts as unknown
COARSE = (1 << 16) - 1


@dataclass(frozen=True)
class Rule:
    """``value`` names the group that must have ``least`` characters; 0 is the whole match."""

    kind: str
    pattern: str
    value: int = 0
    least: int = 0


# The three base rules of the scan.
BASE = [
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}"),
]
MORE = [
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
]

# A query is True (nothing is known), a trigram, or ("and" | "or", queries).


def trigram_query(pattern: str):
    """The trigrams, in lower case, that any match of ``pattern`` must contain."""
    strings, query = _read(parser.parse(pattern))
    return _both(query, _any_of(strings))


def _both(*queries):
    known = [q for q in dict.fromkeys(queries) if q is not True]
    return True if not known else known[0] if len(known) == 1 else ("and", tuple(known))


def _either(*queries):
    distinct = list(dict.fromkeys(queries))
    return True if True in distinct else distinct[0] if len(distinct) == 1 else ("or", tuple(distinct))


def _any_of(strings: set[str] | None):
    if not strings:
        return True
    return _either(*[_both(*[s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _read(nodes) -> tuple[set[str] | None, object]:
    """All strings that the nodes can match, if few (else None), and what is known besides."""
    strings: set[str] | None = {""}
    query, whole = True, True
    for op, value in nodes:
        these, also = _one(op, value)
        query = _both(query, also)
        if these is not None and len(strings) * len(these) <= MAX_STRINGS:
            strings = {a + b for a, b in product(strings, these)}
        else:
            query = _both(query, _any_of(strings))
            whole = False
            strings = these if these is not None else {""}
    if whole:
        return strings, query
    return None, _both(query, _any_of(strings))


def _one(op, value) -> tuple[set[str] | None, object]:
    if op is sre.LITERAL:
        return {chr(value).lower()}, True
    if op is sre.IN:
        if all(o is sre.LITERAL for o, _ in value) and len(value) <= 8:
            return {chr(v).lower() for _, v in value}, True
        return None, True
    if op is sre.SUBPATTERN:
        return _read(value[-1])
    if op is sre.BRANCH:
        read = [_read(x) for x in value[1]]
        if all(s is not None and q is True for s, q in read) and sum(len(s) for s, _ in read) <= MAX_STRINGS:
            return set().union(*[s for s, _ in read]), True
        return None, _either(*[_both(q, _any_of(s)) for s, q in read])
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        low, high, inner = value
        strings, query = _read(inner)
        if strings is not None and query is True and (low, high) == (0, 1):
            return strings | {""}, True
        if low == high == 1:
            return strings, query
        return None, _both(query, _any_of(strings)) if low else True
    if op is sre.AT:
        return {""}, True
    return None, True


def trigrams_of(query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1]))


def _holds(query, has: Column) -> Column:
    """Whether the postings of one document, ``has``, satisfy a query."""
    if isinstance(query, str):
        return F.array_contains(has, query)
    parts = [_holds(q, has) for q in query[1]]
    out = parts[0]
    for p in parts[1:]:
        out = out & p if query[0] == "and" else out | p
    return out


def index(docs: DataFrame, trigrams: set[str], text_col: str = "text") -> DataFrame:
    """Postings (trigram, key) of the given trigrams, in texts read in lower case."""
    low = F.lower(text_col)
    present = F.array_compact(F.array(*[F.when(F.contains(F.col("low"), F.lit(t)), F.lit(t)) for t in sorted(trigrams)]))
    return docs.select("key", low.alias("low")).select("key", F.explode(present).alias("trigram"))


def _matches(texts: DataFrame, rule: Rule, place: int) -> DataFrame:
    """(key, place, kind, start, end) of all matches, in code points."""
    pattern = F.lit(rule.pattern)
    value = F.regexp_extract_all("text", pattern, F.lit(rule.value))
    cut = texts.select(
        "key",
        F.posexplode(F.arrays_zip(
            F.regexp_extract_all("text", pattern, F.lit(0)).alias("whole"), value.alias("value"), F.split("text", rule.pattern, -1).alias("before")
        )).alias("at", "m"),
    ).where(F.col("m.whole").isNotNull())
    sized = cut.select("key", "at", F.length("m.before").alias("gap"), F.length("m.whole").alias("size"), F.length("m.value").alias("n"))
    order = Window.partitionBy("key").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = sized.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(order)).where(F.col("n") >= rule.least)
    return ends.select("key", F.lit(place).alias("place"), F.lit(rule.kind).alias("kind"), (F.col("end") - F.col("size")).alias("start"), "end")


def spans(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, place, kind, start, end) for every match of ``rules`` in the distinct documents."""
    keyed = docs.select(text_key(F.col(id_col), F.col(text_col)).alias("key"), F.coalesce(text_col, F.lit("")).alias("text"))
    queries = [trigram_query(r.pattern) for r in rules]
    indexed = [(i, q) for i, q in enumerate(queries) if q is not True]
    found = []
    if indexed:
        postings = materialize(index(keyed, set().union(*[trigrams_of(q) for _, q in indexed])), "secrets-index")
        per_doc = postings.groupBy("key").agg(F.collect_set("trigram").alias("has"))
        wanted = F.array_compact(F.array(*[F.when(_holds(q, F.col("has")), F.lit(i)) for i, q in indexed]))
        candidates = materialize(per_doc.select("key", wanted.alias("rules")).where(F.size("rules") > 0), "secrets-candidates")
        coarse = candidates.select(F.col("key.hash").bitwiseAND(F.lit(COARSE)).alias("c")).distinct()  # 65,536 rows at most
        near = keyed.join(F.broadcast(coarse), F.col("key.hash").bitwiseAND(F.lit(COARSE)) == F.col("c"), "left_semi")
        named = candidates.select(F.col("key").alias("_key"), "rules")
        texts = near.join(named, F.col("key").eqNullSafe(F.col("_key"))).dropDuplicates(["key"]).select("key", "text", "rules")
        texts = materialize(texts, "secrets-texts")
        found += [_matches(texts.where(F.array_contains("rules", i)), rules[i], i) for i, _ in indexed]
    for i, q in enumerate(queries):
        if q is True:
            found.append(_matches(keyed.where(F.col("text").rlike(rules[i].pattern)).dropDuplicates(["key"]), rules[i], i))
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    return every


def scan(docs: DataFrame, rules: list[Rule] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, and ``found``, its matches by start and then rule."""
    rules = BASE + MORE if rules is None else rules
    matched = spans(docs, rules, id_col, text_col)
    listed = matched.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "place", "kind", "end"))).alias("found"))
    rows = docs.select(id_col, text_key(F.col(id_col), F.col(text_col)).alias("_key"))
    empty = F.array().cast(listed.schema["found"].dataType)
    return rows.join(listed, F.col("_key").eqNullSafe(F.col("key")), "left").select(id_col, F.coalesce("found", empty).alias("found"))


def written(found: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(found, lambda m: F.concat_ws(":", m["kind"], m["start"].cast("string"), m["end"].cast("string"))), ",")
