"""The registered training-data queries: one thin query per operator.

Each applies its operator, with production parameters, to the whole table and
derives the digest columns the query's contract names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.centroids import oracle_sql as centroids_sql
from tillroll.llm.chat import oracle_sql as chat_sql
from tillroll.llm.common import fold, small_batches, table
from tillroll.llm.lexical import oracle_sql as lexical_sql
from tillroll.llm.licenses import oracle_sql as licenses_sql


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pack(docs: DataFrame) -> DataFrame:
    """Documents packed with the 50k byte-level vocabulary, found beside the installed tokenizers."""
    import public_tokenizers

    from tillroll.llm.packing import pack_documents

    return pack_documents(docs, _vocabulary("byte_bpe_50k.json"), ranks=_vocabulary("byte_bpe_50k.tiktoken"),
                          pattern=public_tokenizers.PATTERN)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return pack(table(spark, sf_dir, "documents"))


def op2_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillroll.llm.lm import score_texts

    small_batches(spark)
    return score_texts(table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 7) == 2)


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillroll.llm.topk import top_k

    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillroll.llm.simhash import near_duplicates

    small_batches(spark)
    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillroll.llm.secrets import scan_secrets

    small_batches(spark)
    found = scan_secrets(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[F.expr(f"CAST(size(filter(kinds, k -> k = '{k}')) AS BIGINT)").alias(f"n_{k}")
          for k in ("assign", "access", "hex")],
        "base_sha256", "spans")


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillroll.llm.html import extract

    small_batches(spark)
    return extract(table(spark, sf_dir, "pages"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillroll.llm.langid import fit, identify

    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    found = identify(docs, fit(docs, train=~held_out))
    return found.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillroll.llm.toxicity import fit, score_toxicity

    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    scorer = fit(docs, table(spark, sf_dir, "labels"), train=fold(F.col("doc_id"), 4) != 2)
    return score_toxicity(docs, scorer).select(
        "doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillroll.llm.decontaminate import contaminated

    small_batches(spark)
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillroll.llm.licenses import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillroll.llm.lexical import ranked_search

    small_batches(spark)
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


# The conversation that the contract adds, whose texts hold control strings.
ADDED_TURNS = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillroll.llm.chat import digests, format_chats

    added = spark.createDataFrame(ADDED_TURNS, "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return digests(format_chats(turns, _vocabulary("byte_bpe_50k.json")))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillroll.llm.centroids import cluster

    return cluster(table(spark, sf_dir, "embeddings"), k=8, rounds=10, dims=64, scale=1024, seed=3)


QUERIES = {
    "op1_packing": op1_packing,
    "op2_lm": op2_lm,
    "op3_topk": op3_topk,
    "op4_simhash": op4_simhash,
    "op5_secrets": op5_secrets,
    "op6_html": op6_html,
    "op7_language": op7_language,
    "op8_toxicity": op8_toxicity,
    "op9_decontamination": op9_decontamination,
    "op10_licenses": op10_licenses,
    "op11_lexical": op11_lexical,
    "op12_chat": op12_chat,
    "op13_centroids": op13_centroids,
}

TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20"""

ORACLE_SQL: dict[str, str] = {
    "op3_topk": TOPK_SQL,
    "op10_licenses": licenses_sql(),
    "op11_lexical": lexical_sql(k=20),
    "op12_chat": chat_sql(", ".join(f"({c}, {t}, '{r}', '{x}')" for c, t, r, x in ADDED_TURNS)),
    "op13_centroids": centroids_sql(k=8, rounds=10, dims=64, scale=1024, seed=3),
}
