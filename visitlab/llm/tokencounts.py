"""Exact length histogram of encoded documents.

Every text is encoded whole; each Arrow batch is counted by length before
anything is shuffled, so the histogram costs rows only for distinct lengths.
Suffix sums over it answer totals, quantiles and truncated totals for every
context limit: with N(l) documents longer than l and T(l) tokens in documents of
at most l tokens, a limit l keeps T(l) + l * N(l) tokens.

Defined results: a null or empty text has length 0; repeated documents count as
often as they occur; an empty table gives an empty histogram, a report with
totals 0 and null quantiles. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, materialize
from .encode import encoder

#: Lengths in one block of the suffix sums.
BLOCK = 1024


def counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(n_tokens, n_docs): documents by encoded length."""

    @lean("encoder")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            seen = Counter(len(encode.ids(t.as_py())) for t in batch["text"])
            yield pa.RecordBatch.from_pydict({"n_tokens": pa.array(list(seen), pa.int64()), "n_docs": pa.array(list(seen.values()), pa.int64())})

    part = docs.select(F.col("text").cast("string")).mapInArrow(run, "n_tokens long, n_docs long")
    return part.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def histogram(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row per length: n_tokens, n_docs, tokens, docs_ge and tokens_ge (of
    documents at least that long), truncated_total (tokens left if n_tokens is
    the context limit) and share_le (share of documents at most that long)."""
    rows = materialize(counts(docs, tokenizer), "lengths").withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    rows = rows.withColumn("block", F.floor(F.col("n_tokens") / BLOCK))
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("bd"), F.sum("tokens").alias("bt"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)  # one row per 1024 lengths
    every = Window.partitionBy()
    after = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    blocks = blocks.select("block", after("bd", later).alias("bd"), after("bt", later).alias("bt"),
                           F.sum("bd").over(every).alias("all_docs"), F.sum("bt").over(every).alias("all_tokens"))
    inner = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    out = (rows.join(blocks, "block").withColumn("docs_ge", F.col("bd") + F.sum("n_docs").over(inner))
           .withColumn("tokens_ge", F.col("bt") + F.sum("tokens").over(inner)))
    return out.select("n_tokens", "n_docs", "tokens", "docs_ge", "tokens_ge",
                      (F.col("all_tokens") - F.col("tokens_ge") + F.col("n_tokens") * F.col("docs_ge")).alias("truncated_total"),
                      ((F.col("all_docs") - F.col("docs_ge") + F.col("n_docs")) / F.col("all_docs")).alias("share_le"))


def report(hist: DataFrame, limits: list[int], quantiles: list[float]) -> DataFrame:
    """One row: docs, tokens, for each limit total_<limit>, for each q the least
    length that a share of at least q of the documents does not exceed (q_<q>)."""
    totals = [F.coalesce(F.sum(F.least("n_tokens", F.lit(x)) * F.col("n_docs")), F.lit(0)).alias(f"total_{x}") for x in limits]
    qs = [F.min(F.when(F.col("share_le") >= q, F.col("n_tokens"))).alias(f"q_{q}") for q in quantiles]
    return hist.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("docs"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), *totals, *qs)
