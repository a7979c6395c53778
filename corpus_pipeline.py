"""A cleaning pipeline over ``documents``: five stages, each written as Parquet
and read again as the next one's documents.

Toxic documents go, one document of each group of near-duplicates stays,
documents with benchmark questions go, sources are mixed to target weights (a
document may then occur twice), and the rest is written as token files, whose
contents are the result: doc_id, start, n_tokens, ids_crc32.

Defined results: all columns of the documents are kept, whatever their names, up
to the last stage. A null or empty text is scored by the model's bias, resembles
nothing, holds no question, and is mixed like other rows but adds no words. Rows equal
in doc_id and text are one document from the second stage on; texts that share a
doc_id are documents of their own; rows with a null doc_id resemble nothing. An
empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlab.llm import decontaminate, mixing, neardup, tokenfiles, toxicity
from visitlab.llm.common import configure, free_name, materialize, scratch_path, table
from visitlab.llm.queries import tokenizer_path, training_labels


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under 0.5 (operator 8)."""
    configure(spark)
    model = toxicity.train(docs, training_labels(spark, sf_dir))
    score = free_name(docs, "toxicity")
    return toxicity.score_table(docs, model, score).where(F.col(score) < 0.5).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (operator 9)."""
    configure(spark)
    return neardup.keep_one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark questions (operator 1)."""
    configure(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture draws them (operator 6)."""
    configure(spark)
    return mixing.mixture(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files with their index, read back (operator 2)."""
    configure(spark)
    path = scratch_path(spark, "corpus-tokens")
    tokenfiles.write(docs, path, tokenizer_path())
    return tokenfiles.read_back(docs, path)


STAGES = [
    ("toxicity", drop_toxic),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token files", write_tokens),
]

#: Hashing, training and encoding have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
