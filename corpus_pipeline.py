"""Training-corpus pipeline over ``documents``.

Stages, each over all that the one before it kept:

1. language ID: documents whose language the models reject are dropped;
2. SimHash near-dedup: of each component the smallest doc_id stays;
3. benchmark decontamination: documents with a benchmark passage are dropped;
4. secret scans: every reported span is masked in the text;
5. packing: the texts become sequences of at most 1024 tokens, one row a piece.

Every stage but the last returns the columns of ``documents``.  A null text is
rejected by the first stage.  No stage is expressible in SQL, so ORACLE_SQL is
None; tests compare with a brute-force version, the language stage by its accuracy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import decontaminate, langid, secrets, simhash
from tillroll.llm.common import delete_folder, fold, shared_folder, small_batches, table
from tillroll.llm.queries import pack


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return langid.accepted(docs, langid.fit(docs, train=fold(F.col("doc_id"), 4) != 2))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return simhash.one_per_component(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return secrets.mask_secrets(docs, length_col="n_chars")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return pack(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_masking", secret_masking),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written as Parquet and read again.

    A stage's table goes once the next one is written; the last is read by the result."""
    docs, before = table(spark, sf_dir, "documents"), None
    folder = shared_folder(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete_folder(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
