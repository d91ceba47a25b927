"""Held-out marks and the bounded labelled sample that classifiers are fitted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % by


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, by: int, held: int, rows: int) -> DataFrame:
    """(doc_id, text, y) of at most ``rows`` labelled ids that are not held out, spread by hash.

    Only the sample for fitting is bounded. Ids that are null or labelled null drop out; of repeated labels the
    largest counts; a text that comes back word for word counts once.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), by) != held))
    known = known.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y"))
    chosen = known.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(rows)
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    # the sample has ``rows`` ids at most, which bounds what is broadcast
    found = docs.select("doc_id", text).join(F.broadcast(chosen), "doc_id")
    once = found.groupBy(F.sha2("text", 256).alias("digest")).agg(F.min("doc_id").alias("doc_id"))
    return found.join(F.broadcast(once.select("doc_id")), "doc_id").dropDuplicates(["doc_id"])
