"""The registered queries of this subpackage: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bitplanes, chat, decontaminate, mixing, neardup, novelty, periodic, pii, sharding, tokencounts, tokenfiles, topk,
               toxicity)
from .common import configure, scratch_path, table

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Place of a vocabulary file of the public tokenizers package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = scratch_path(spark, "token-files")
    tokenfiles.write(docs, path, tokenizer_path())
    return tokenfiles.read_back(docs, path)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = r"\### Assistant: </turn> ok"
    own = (spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text")))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.digests(chat.format_conversations(rows))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.histogram(table(spark, sf_dir, "documents"), tokenizer_path())


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels that training may see: crc32 of the id is not 0 modulo 5."""
    return table(spark, sf_dir, "labels").where("crc32(cast(doc_id as string)) % 5 <> 0").select("doc_id", "toxic")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_table(docs, toxicity.train(docs, training_labels(spark, sf_dir)))
    return scored.select("doc_id", F.expr("coalesce(crc32(cast(doc_id as string)) % 5 = 0, false)").alias("held_out"), "score",
                         F.expr("cast(score >= 0.5 as int)").alias("predicted"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return novelty.secrets(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digests(table(spark, sf_dir, "documents"), plant=True)


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitplanes.cluster(table(spark, sf_dir, "embeddings"))


def _configured(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    return run


REGISTRY = {fn.__name__: _configured(fn) for fn in (
    op1_decontaminate, op2_token_files, op3_sharding, op4_chat, op5_pii, op6_mixing, op7_token_counts, op8_toxicity,
    op9_near_duplicates, op10_top_k, op11_secrets, op12_periodic_runs, op13_centroids)}



def _centroid_sql() -> str:
    """Three rounds and a last assignment, each a pair of named queries; sums are
    floored by the remainder's sign, as integer division cuts towards zero."""
    assign = """
a{i} AS (
  SELECT vec_id, v, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT v.vec_id, v.v, c.c, CAST(list_sum(list_transform(list_zip(v.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM v, c{i} c)
  GROUP BY vec_id, v)"""
    move = """,
m{i} AS (
  SELECT c, list(f ORDER BY k) AS v FROM (
    SELECT c, k, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS f
    FROM (SELECT c, unnest(v) AS x, unnest(range(1, 65)) AS k FROM a{i}) GROUP BY c, k) GROUP BY c),
c{j} AS (SELECT c.c, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m USING (c)),"""
    steps = "".join(assign.format(i=i) + (move.format(i=i, j=i + 1) if i < bitplanes.ROUNDS else "") for i in range(bitplanes.ROUNDS + 1))
    last = bitplanes.ROUNDS
    return f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS (SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS INTEGER) AS c, v FROM v
       ORDER BY sha256('1:' || vec_id) LIMIT {bitplanes.K}),{steps},
p AS (SELECT c, CAST(sum(d) AS BIGINT) AS cluster_inertia, count(*) AS cluster_size FROM a{last} GROUP BY c)
SELECT vec_id, a.c AS cluster, d AS distance, cluster_inertia, (SELECT CAST(sum(d) AS BIGINT) FROM a{last}) AS inertia,
       sha256(array_to_string(k.v, ',')) AS centroid_sha256, cluster_size
FROM a{last} a JOIN p USING (c) JOIN c{last} k USING (c)"""


#: DuckDB SQL where it can express the result; the tests hold the other queries
#: against brute force.
ORACLE: dict[str, str] = {
    "op3_sharding": f"""
WITH d AS (
  SELECT doc_id, CAST(coalesce(octet_length(encode(text)), 0) AS BIGINT) AS n_bytes,
         lpad(bin(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT)), 60, '0') AS bits
  FROM documents),
sums AS (
  SELECT depth, substr(bits, 1, depth) AS shard FROM d, (SELECT unnest(range(0, 40)) AS depth) WHERE n_bytes <= {sharding.LIMIT}
  GROUP BY ALL HAVING sum(n_bytes) <= {sharding.LIMIT})
SELECT doc_id, n_bytes, min_by(shard, s.depth) AS shard, CAST(min(s.depth) AS INTEGER) AS depth, false AS oversize
FROM d JOIN sums s ON s.shard = substr(d.bits, 1, s.depth) GROUP BY doc_id, n_bytes""",
    # a text with a control string is escaped: one more character in its opening
    # marker and one for every backslash and < in it
    "op4_chat": r"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text) AS told,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text) FILTER (role = 'assistant'), '') AS learned,
         sum(17 + length(coalesce(role, '--')) + length(text)
             + CASE WHEN contains(text, '<turn') OR contains(text, '</turn')
                    THEN 1 + length(text) - length(translate(text, '\<', '')) ELSE 0 END) AS formatted_chars
  FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, CAST(length(learned) AS BIGINT) AS loss_chars, sha256(learned) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM g""",
    "op9_near_duplicates": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x09-\x0D\x20]+'), lambda x: x <> '') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(words[k:k + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS k FROM w WHERE len(words) > 0)),
n AS (SELECT w.doc_id, count(s.shingle) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id),
link AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reach AS (SELECT doc_id, doc_id AS other FROM n UNION SELECT r.doc_id, l.b FROM reach r JOIN link l ON l.a = r.other)
SELECT doc_id, n AS n_shingles, c AS component_id, doc_id = c AS kept
FROM n JOIN (SELECT doc_id, min(other) AS c FROM reach GROUP BY doc_id) USING (doc_id)""",
    "op10_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    "op13_centroids": _centroid_sql(),
}
