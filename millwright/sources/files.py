"""Batch file sources."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from ..schemas import Family

PARTS_PER_SPLIT = 8
DOCUMENTS = "{*.json,part-*.txt,part-*.txt.gz}"  # uploaded, or landed by ``jobs.land_posted``


class SourceUnreadable(Exception):
    """The input path does not exist or cannot be read."""


def run_day(text: str | None = None) -> date:
    """The day to process: an ISO or compact date, else yesterday in UTC."""
    if text and text.strip():
        clean = text.strip().replace("-", "")
        return datetime.strptime(clean, "%Y%m%d").date()
    return datetime.now(timezone.utc).date() - timedelta(days=1)


def parquet_day(spark: SparkSession, root: str, day: date, schema: T.StructType) -> DataFrame:
    """Staged rows of one day, typed as declared.

    The lake stream partitions by ``ingest_date=yyyyMMdd``; reading the table as a whole keeps the stream's commit log
    in force, and the filter lists one partition. A plain folder ``root/yyyyMMdd`` from elsewhere is read as well.
    """
    root = root.rstrip("/")
    try:
        try:
            raw = spark.read.parquet(f"{root}/{day:%Y%m%d}/")
        except AnalysisException:
            raw = spark.read.option("basePath", root).parquet(root)
            if "ingest_date" not in raw.columns:
                raise
            raw = raw.where(F.col("ingest_date").cast("string") == f"{day:%Y%m%d}").drop("ingest_date")
    except AnalysisException as error:
        raise SourceUnreadable(str(error)) from error
    present = set(raw.columns)
    return raw.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def partition_day(table: DataFrame, column: str, day: date) -> DataFrame:
    """One day of a table that is partitioned by a date column; other partitions are not listed."""
    return table.where(F.col(column) == F.lit(f"{day:%Y-%m-%d}").cast(table.schema[column].dataType))


def csv_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Columns of ``schema`` by header name; a column that the file lacks is null, as is a value that does not fit.

    Files of one read must agree in their headers, or the read fails.
    """
    wanted = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    return raw.select(
        *[
            (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in raw.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in wanted.fields
        ]
    )


def sensor_history(spark: SparkSession, path: str, family: Family) -> DataFrame:
    """Labelled history of one family from CSV."""
    return csv_table(spark, path, family.history_schema)


def documents(spark: SparkSession, root: str, day: date | None = None) -> DataFrame:
    """Record texts of JSON-array documents: doc_id (file path), pos, raw.

    A document is one posted batch and one file. A document that is no JSON array,
    or an empty one, gives a single row with its whole text, so it still gets a verdict.
    """
    path = f"{root.rstrip('/')}/" + (f"date={day:%Y-%m-%d}/" if day else "")
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", DOCUMENTS)
    texts = reader.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("doc_id"), "value")
    return explode_documents(texts)


def document_stream(spark: SparkSession, root: str, **options: str) -> DataFrame:
    """New documents below ``root`` as they land: doc_id (file path) and value (the whole text), one row each.

    ``maxFilesPerTrigger`` and ``maxBytesPerTrigger`` bound a batch.
    """
    reader = spark.readStream.option("recursiveFileLookup", True).option("pathGlobFilter", DOCUMENTS)
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.text(root, wholetext=True).select(F.col("_metadata.file_path").alias("doc_id"), "value")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Share the rows of a small input among all cores before costly row work.

    An input with at least as many splits as there are cores is left alone, so
    nothing is shuffled at scale. The keys should tell rows apart.
    """
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def enough_parts(df: DataFrame) -> int | None:
    """Partitions in which a join of ``df`` sorts in memory, where the session's own number is too small; else None.

    A split of a file is cut into ``PARTS_PER_SPLIT``. A session with as many shuffle partitions, and an input with a split
    per core, are left to adaptive execution.
    """
    splits, cores = df.rdd.getNumPartitions(), df.sparkSession.sparkContext.defaultParallelism
    wanted = max(cores, PARTS_PER_SPLIT * splits)
    if splits >= cores and int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) >= wanted:
        return None
    return wanted


def explode_documents(texts: DataFrame) -> DataFrame:
    """(doc_id, value) documents to one row per record."""
    elements = F.from_json("value", "array<string>")
    whole = F.array("value")
    elements = F.when(F.size(elements) > 0, elements).otherwise(whole)
    rest = [c for c in texts.columns if c != "value"]
    return texts.select(
        *rest, F.posexplode(elements).alias("pos", "raw")
    ).withColumn("pos", F.col("pos").cast("long"))


def doc_date(doc_id: Column) -> Column:
    """Ingest date from a ``date=yyyy-MM-dd`` path element."""
    return F.nullif(F.regexp_extract(doc_id, r"date=(\d{4}-\d{2}-\d{2})", 1), F.lit(""))
