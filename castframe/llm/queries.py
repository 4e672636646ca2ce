"""The dealt operators as queries over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from castframe.llm import ann, decontaminate, langid, lexical, licenses, linededup, manifest, mixing, quality, runindex, secretscan, simhash, tokencounts
from castframe.llm.common import table
from castframe.llm.oracle import ORACLE  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = langid.held_out(F.col("doc_id")).alias("held_out")
    return langid.identify(docs).select("doc_id", held, "lang_pred", "score")


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.report(table(spark, sf_dir, "documents"))


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # The key is the id, nulls last.
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"))
    found = simhash.near_duplicates(docs, key)
    return found.select(
        F.col("key.doc_id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"),
    )


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secretscan.scan(table(spark, sf_dir, "documents"))
    kinds = [r.kind for r in secretscan.BASE]
    base = F.filter("found", lambda m: m["kind"].isin(kinds))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda m: m["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, kinds), F.sha2(secretscan.written(base), 256).alias("base_sha256"), secretscan.written(F.col("found")).alias("spans")
    )


@query
def op5_token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.histogram(tokencounts.lengths(table(spark, sf_dir, "documents")))


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.digest(decontaminate.find(docs, table(spark, sf_dir, "benchmark")))


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), max_repeats=2.0)


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runindex.without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = ann.vectors_of(table(spark, sf_dir, "embeddings"))
    return ann.nearest(vectors, vectors.where(F.col("id") % 50 == 0))


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = {c: F.col(c) for c in manifest.FIELDS}
    tampered = fields | {"n_chars": F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    proofs = manifest.manifest(docs, {"claimed": manifest.leaf_digest(tampered)})
    proofs = proofs.withColumn("folded", manifest.folded(F.col("claimed"), F.col("siblings")))
    return proofs.select(
        "doc_id", *[manifest.shown(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
        manifest.proof_digest(F.col("siblings")).alias("proof_sha256"), manifest.shown(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


@query
def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"), ~langid.held_out(F.col("doc_id")))
    held = langid.held_out(F.col("doc_id")).alias("held_out")
    return quality.score(docs, model).select("doc_id", held, "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
