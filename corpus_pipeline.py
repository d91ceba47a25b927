"""The corpus pipeline: documents through five of the numbered operators, stage by stage.

Rows are told apart by their place in the stage's input, so repeated rows and ids are judged each by itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.llm import bpe, credentials, decontaminate, simhash, toxicity
from millwright.llm.common import ROW, numbered, table
from millwright.llm.queries import vocabulary_path
from millwright.session import scratch_dir, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go; the classifier is fitted on these documents and ``labels``."""
    return toxicity.accepted(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, the one with the smallest doc_id."""
    rows = numbered(docs)
    return rows.join(simhash.one_of_each(rows, ("doc_id", ROW)).select(ROW), ROW, "left_semi").drop(ROW)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    rows = numbered(docs)
    # written, so that Spark knows its size when it plans the join: the documents are shuffled only if it is large
    found = written(decontaminate.contaminated(rows, table(spark, sf_dir, "benchmark")), "contaminated")
    return rows.join(found, ROW, "left_anti").drop(ROW)


def secrets_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets and confirmed credential parts are masked in the text, and n_chars follows; no document goes."""
    rows = numbered(docs)
    found = written(credentials.scan(rows, (ROW,)).where(F.size("spans") > 0).select(ROW, "spans"), "secrets")
    masked = rows.join(found, ROW, "left").withColumn(
        "text", F.when(F.col("spans").isNotNull(), credentials.redacted(F.col("text"), F.col("spans"))).otherwise(F.col("text"))
    )
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        masked = masked.withColumn("n_chars", F.when(F.col("spans").isNotNull(), size).otherwise(F.col("n_chars")))
    return masked.select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang and source with the token ids, their number, and the digest of the decoded text."""
    coded = bpe.encode(docs, vocabulary_path(), ("doc_id", "lang", "source"))
    return coded.select("doc_id", "lang", "source", F.size("ids").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic_out),
    ("simhash", near_dedup),
    ("decontamination", decontaminated),
    ("secrets", secrets_masked),
    ("bpe", encoded),
]

#: A trained model, Hamming components and byte-pair merges can't be expressed in SQL; brute-force tests stand in.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
