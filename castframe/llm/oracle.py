"""SQL for the queries that SQL can express, as brute force and without the operators' methods."""

from __future__ import annotations

import math
import re

from castframe.llm import licenses, secretscan

ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _words(table: str, key: str) -> str:
    return f"""
  SELECT {key}, generate_subscripts(w, 1) - 1 AS pos, unnest(w) AS word
  FROM (SELECT {key}, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{ANY_CASE}') AS w
        FROM {table})"""


def _secrets() -> str:
    parts = []
    for place, rule in enumerate(secretscan.BASE + secretscan.MORE):
        pattern = rule.pattern.replace("'", "''")
        parts.append(f"""
  SELECT doc_id, {place} AS place, '{rule.kind}' AS kind, unnest(range(1, len(whole) + 1)) AS i, whole, val, gap, {rule.least} AS least
  FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}', 0) AS whole, regexp_extract_all(text, '{pattern}', {rule.value}) AS val,
               string_split_regex(text, '{pattern}') AS gap
        FROM documents WHERE regexp_matches(text, '{pattern}'))""")
    kinds = [r.kind for r in secretscan.BASE]
    base = ", ".join(f"'{k}'" for k in kinds)
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in kinds)
    return f"""
WITH every AS ({" UNION ALL ".join(parts)}),
ends AS (
  SELECT doc_id, place, kind, length(whole[i]) AS size,
         CAST(list_sum(list_transform(gap[1:i], lambda x: length(x))) + list_sum(list_transform(whole[1:i], lambda x: length(x))) AS BIGINT) AS stop
  FROM every WHERE length(val[i]) >= least),
spans AS (SELECT *, stop - size AS start, kind || ':' || (stop - size) || ':' || stop AS said FROM ends)
SELECT doc_id, {counts},
       sha256(coalesce(string_agg(said, ',' ORDER BY start, place) FILTER (WHERE kind IN ({base})), '')) AS base_sha256,
       coalesce(string_agg(said, ',' ORDER BY start, place), '') AS spans
FROM documents LEFT JOIN spans USING (doc_id) GROUP BY doc_id"""


def _licenses(threshold: float = 0.8) -> str:
    rows = []
    for t, (label, text) in enumerate(licenses.TEMPLATES):
        words = sorted(set(re.findall(licenses.WORD, text.lower())))
        need = math.ceil(threshold * len(words) - 1e-9)
        rows += [f"({t}, '{label}', '{w}', {len(words)}, {need})" for w in words]
    phrases = []
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split()
        joins = " ".join(f"JOIN words w{i} ON w{i}.doc_id = w0.doc_id AND w{i}.pos = w0.pos + {i} AND w{i}.word = '{p}'" for i, p in enumerate(parts) if i)
        phrases.append(f"SELECT w0.doc_id, w0.pos, '{label}' AS label FROM words w0 {joins} WHERE w0.word = '{parts[0]}'")
    half = licenses.STRIDE
    return f"""
WITH words AS ({_words("documents", "doc_id")}),
templates(template, label, word, size, need) AS (VALUES {", ".join(rows)}),
said AS ({" UNION ALL ".join(phrases)}),
in_block AS (
  SELECT DISTINCT doc_id, word, unnest([pos // {half} - 1, pos // {half}]) AS block
  FROM words WHERE word IN (SELECT word FROM templates)),
overlap AS (
  SELECT doc_id, block, template, label, size, need, count(*) AS n
  FROM in_block JOIN templates USING (word) WHERE block >= 0 GROUP BY ALL),
found AS (SELECT doc_id, label, n / size AS part FROM overlap WHERE n >= need),
labelled AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT doc_id, label FROM found UNION ALL SELECT doc_id, label FROM said) GROUP BY doc_id),
best AS (SELECT doc_id, max(part) AS part FROM found GROUP BY doc_id),
based AS (
  SELECT doc_id, count(*) AS n, min(pos) AS low, max(pos) AS high, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM said GROUP BY doc_id),
sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id)
SELECT d.doc_id, coalesce(sizes.n, 0) AS n_words, coalesce(based.n, 0) AS n_base, CAST(low AS BIGINT) AS first_word,
       CAST(high AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(CASE WHEN based.n > 0 THEN 1.0 ELSE coalesce(best.part, 0.0) END AS DOUBLE) AS score
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN based USING (doc_id) LEFT JOIN labelled USING (doc_id) LEFT JOIN best USING (doc_id)"""


def _contamination(window: int = 10) -> str:
    return f"""
WITH words AS ({_words("documents", "doc_id")}),
items AS (SELECT item_id, list(word ORDER BY pos) AS w FROM ({_words("benchmark", "item_id")}) GROUP BY item_id),
windows AS (
  SELECT DISTINCT item_id, len(run) AS size, array_to_string(run, ' ') AS run
  FROM (SELECT item_id, w[i : i + {window} - 1] AS run
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {window}, 0) + 2)) AS i FROM items))),
texts AS (SELECT doc_id, list(word ORDER BY pos) AS w FROM words GROUP BY doc_id),
runs AS (
  SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS run
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM texts, (SELECT DISTINCT size FROM windows))),
met AS (SELECT doc_id, i, item_id, r.size FROM runs r JOIN windows USING (size, run)),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS pos FROM met) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(t.w), 0) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM documents d LEFT JOIN texts t USING (doc_id) LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""


def _mixture(limit: float = 2.0, steps: int = 50) -> str:
    fits = f"pow(ratio, 1 - (low + high) / 2) <= {limit}"
    return f"""
WITH RECURSIVE counted AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{ANY_CASE}')) AS BIGINT) AS n_tokens FROM documents),
sources AS (SELECT source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM counted GROUP BY source),
ends AS (SELECT CAST(max(tokens) AS DOUBLE) AS most, CAST(max(tokens) AS DOUBLE) / min(tokens) AS ratio FROM sources WHERE tokens > 0),
halves(i, low, high, ratio) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE), ratio FROM ends
  UNION ALL
  SELECT i + 1, CASE WHEN {fits} THEN low ELSE (low + high) / 2 END, CASE WHEN {fits} THEN (low + high) / 2 ELSE high END, ratio
  FROM halves WHERE i < {steps}),
chosen AS (SELECT CASE WHEN ratio <= {limit} THEN CAST(0 AS DOUBLE) ELSE high END AS exponent FROM halves WHERE i = {steps}),
tempered AS (
  SELECT source, tokens, CASE WHEN tokens > 0 THEN pow(most / tokens, 1 - exponent) ELSE 1.0 END AS epochs FROM sources, ends, chosen),
budgets AS (
  SELECT source, CAST(floor(epochs) AS BIGINT) AS passes, CAST(floor((epochs - floor(epochs)) * tokens + 0.5) AS BIGINT) AS rest FROM tempered),
copies AS (
  SELECT doc_id, counted.source, n_tokens, passes, rest,
         unnest(range(0, CASE WHEN n_tokens = 0 THEN 1 ELSE passes + CASE WHEN rest > 0 THEN 1 ELSE 0 END END)) AS epoch
  FROM counted JOIN budgets ON counted.source IS NOT DISTINCT FROM budgets.source),
dealt AS (
  SELECT *, md5('block/' || doc_id)[1:3] AS block, md5(doc_id || '/' || epoch) AS place FROM copies),
blocks AS (
  SELECT source, epoch, block, sum(sum(n_tokens)) OVER (
    PARTITION BY source, epoch ORDER BY md5(block || '/' || coalesce(source, 'null') || '/' || epoch), block
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier
  FROM dealt GROUP BY source, epoch, block),
placed AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY source, epoch, block ORDER BY place, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS inside
  FROM dealt)
SELECT doc_id, p.source, n_tokens, CAST(p.epoch AS INTEGER) AS epoch, p.block, CAST(coalesce(earlier, 0) + coalesce(inside, 0) AS BIGINT) AS start_token
FROM placed p JOIN blocks b ON p.source IS NOT DISTINCT FROM b.source AND p.epoch = b.epoch AND p.block = b.block
WHERE p.epoch < passes OR n_tokens = 0 OR coalesce(earlier, 0) + coalesce(inside, 0) < rest"""


def _merkle() -> str:
    def leaf(n_chars: str) -> str:
        fields = ("CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text")
        return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"

    def levels(name: str, leaves: str, tree: str, digest: str) -> str:
        return f"""
{name}_lists(tree, lvl, h) AS (
  SELECT {tree}, 0, list({digest} ORDER BY idx) FROM {leaves} GROUP BY ALL
  UNION ALL
  SELECT tree, lvl + 1, list_transform(range(0, (len(h) + 1) // 2), lambda i: sha256(h[2 * i + 1] || coalesce(h[2 * i + 2], '')))
  FROM {name}_lists WHERE len(h) > 1),
{name}_nodes AS (SELECT tree, lvl, generate_subscripts(h, 1) - 1 AS idx, unnest(h) AS digest FROM {name}_lists),
{name}_tops AS (SELECT tree, lvl AS depth, h[1] AS digest FROM {name}_lists WHERE len(h) = 1)"""

    def climb(name: str, first: str) -> str:
        # The own node is folded from the claimed leaf, the siblings are the original ones.
        sibling = "coalesce(s.digest, '')"
        return f"""
{name}_way(id, tree, lvl, idx, own, proof) AS (
  {first}
  UNION ALL
  SELECT w.id, w.tree, w.lvl + 1, w.idx // 2,
         sha256(CASE WHEN w.idx % 2 = 0 THEN w.own || {sibling} ELSE {sibling} || w.own END), w.proof || {sibling}
  FROM {name}_way w JOIN {name}_tops t ON t.tree IS NOT DISTINCT FROM w.tree AND w.lvl < t.depth
  LEFT JOIN {name}_nodes s ON s.tree IS NOT DISTINCT FROM w.tree AND s.lvl = w.lvl AND s.idx = CASE WHEN w.idx % 2 = 0 THEN w.idx + 1 ELSE w.idx - 1 END),
{name}_end AS (
  SELECT w.* FROM {name}_way w JOIN {name}_tops t ON t.tree IS NOT DISTINCT FROM w.tree AND w.lvl = t.depth)"""

    octets = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))"
    shift = "CASE WHEN x % 2 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END"
    eight = f"list_reduce(list_prepend(xor(c, b), CAST(range(8) AS BIGINT[])), lambda x, _: {shift})"
    crc = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}), lambda c, b: {eight}), CAST(4294967295 AS BIGINT))"
    changed = f"CASE WHEN ({crc}) % 7 = 0 THEN n_chars + 1 ELSE n_chars END"
    up = "SELECT e.id, 0, 0, s.idx, e.own, e.proof FROM low_end e JOIN subroots s ON s.lang IS NOT DISTINCT FROM e.tree"
    return f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, lang, {leaf("n_chars")} AS leaf, {leaf(changed)} AS claimed FROM documents),
leaves AS (
  SELECT *, row_number() OVER () AS id, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM hashed),
{levels("low", "leaves", "lang", "leaf")},
subroots AS (SELECT tree AS lang, digest, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS idx FROM low_tops),
{levels("high", "subroots", "0", "digest")},
{climb("low", "SELECT id, lang, 0, idx, claimed, '' FROM leaves")},
{climb("high", up)}
SELECT l.doc_id, l.leaf, s.digest AS subroot, r.digest AS root, sha256(e.proof) AS proof_sha256, e.own AS folded_root, e.own = r.digest AS verified
FROM high_end e JOIN leaves l USING (id) JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang, high_tops r"""


def _ranked(k: int = 10) -> str:
    return f"""
WITH words AS ({_words("documents", "doc_id")}),
asked AS (SELECT item_id, word, count(*) AS times FROM ({_words("benchmark", "item_id")}) GROUP BY ALL),
sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
counts AS (SELECT doc_id, word, count(*) AS tf FROM words WHERE word IN (SELECT word FROM asked) GROUP BY ALL),
weights AS (
  SELECT word, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM counts, total GROUP BY word, docs),
norms AS (SELECT doc_id, 100 - 75 + (75 * n * docs) // terms AS m FROM sizes, total),
scores AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (word) JOIN counts USING (word) JOIN norms USING (doc_id) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0) WHERE rank <= {k}"""


ORACLE = {
    "op4_secret_scan": _secrets(),
    "op6_decontamination": _contamination(),
    "op7_mixing": _mixture(),
    "op10_license_scan": _licenses(),
    "op11_lexical_search": _ranked(),
    "op12_merkle_manifest": _merkle(),
}
