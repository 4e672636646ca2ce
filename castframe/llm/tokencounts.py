"""Token counts from an exact histogram of encoded lengths.

Documents are encoded once and counted by their length in tokens. Sums over the
histogram from a length upwards then answer totals, quantiles and totals after
truncation for any context limit, without the documents.

The vocabulary is one of the public byte-level ranks files; its path is a
parameter. It is read by the driver and sent to the tasks (a fixed file of a few
megabytes).

Defined cases: a null or empty text has length 0. Repeated rows count each. Extra
columns are not read. An empty table gives an empty histogram, for which quantiles
are null and totals 0.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from castframe.llm.common import bounded_batches
from castframe.session import materialize, ship

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how that vocabulary's texts are split into words.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WIDTH = 4096  # lengths that share a bucket; the sum over buckets sees longest / WIDTH rows


def lengths(docs: DataFrame, vocabulary: str = VOCABULARY, text_col: str = "text", split: str = SPLIT) -> DataFrame:
    """(n_tokens) for every row."""
    spark = docs.sparkSession
    ship(spark)
    bounded_batches(spark)
    with open(vocabulary, "rb") as file:
        ranks = spark.sparkContext.broadcast(file.read())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.value.splitlines())}
        own = tiktoken.Encoding("own", pat_str=split, mergeable_ranks=table, special_tokens={})
        for batch in batches:
            counts = [len(own.encode_ordinary(t.as_py() or "")) for t in batch.column("text")]
            yield pa.RecordBatch.from_pydict({"n_tokens": pa.array(counts, pa.int64())})

    return docs.select(F.col(text_col).alias("text")).mapInArrow(encode, "n_tokens long")


def histogram(counted: DataFrame) -> DataFrame:
    """One row per length: n_tokens, n_docs, and the sums from it upwards.

    docs_at_least and tokens_at_least count documents of this length or more;
    tokens_if_truncated is the total if every document ends at this length;
    docs_at_most counts those of this length or less.
    """
    exact = materialize(counted.groupBy("n_tokens").agg(F.count("*").alias("n_docs")), "token-lengths")
    exact = exact.withColumns({"bucket": F.floor(F.col("n_tokens") / WIDTH), "tokens": F.col("n_tokens") * F.col("n_docs")})
    longer = Window.orderBy(F.col("bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    totals = exact.groupBy("bucket").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    above = totals.select("bucket", *[F.coalesce(F.sum(c).over(longer), F.lit(0)).alias(f"{c}_above") for c in ("d", "t")])
    inside = Window.partitionBy("bucket").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = exact.select("*", F.sum("n_docs").over(inside).alias("d"), F.sum("tokens").over(inside).alias("t")).join(above, "bucket")
    every, every_token = (F.lit(x or 0) for x in exact.agg(F.sum("n_docs"), F.sum("tokens")).first())
    more_docs, more_tokens = F.col("d") + F.col("d_above"), F.col("t") + F.col("t_above")
    return joined.select(
        "n_tokens", "n_docs", more_docs.alias("docs_at_least"), more_tokens.alias("tokens_at_least"),
        (every_token - more_tokens + F.col("n_tokens") * more_docs).alias("tokens_if_truncated"),
        (every - more_docs + F.col("n_docs")).alias("docs_at_most"),
    )


def quantiles(hist: DataFrame, shares: list[float]) -> list[int | None]:
    """The least length that at least the given share of documents do not exceed."""
    every = hist.agg(F.sum("n_docs")).first()[0]
    if not every:
        return [None] * len(shares)
    row = hist.agg(*[F.min(F.when(F.col("docs_at_most") >= F.lit(s) * every, F.col("n_tokens"))).alias(f"q{i}") for i, s in enumerate(shares)]).first()
    return list(row)


def truncated_totals(hist: DataFrame, limits: list[int]) -> list[int]:
    """The total of tokens if no document has more than the limit, for each limit."""
    kept: list[Column] = [F.sum(F.least("n_tokens", F.lit(limit)) * F.col("n_docs")).alias(f"l{i}") for i, limit in enumerate(limits)]
    return [x or 0 for x in hist.agg(*kept).first()]
