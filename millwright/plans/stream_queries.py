"""Streaming flows as queries: each runs to the end of its input and returns what it wrote."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import flatten
from ..schemas import FAMILIES, STAR_TABLES
from ..session import PACKED, scratch_dir, shuffles_removed
from ..sources import shapes
from ..sources.files import run_day
from ..sources.streams import table_stream
from ..streaming import flows
from . import jobs, serving
from .explore_queries import complete
from .sensor_queries import engineered_score, score_rows

ARM = FAMILIES["arm_robot"]


def _places(spark: SparkSession, label: str) -> tuple[str, str]:
    root = scratch_dir(spark, label)
    return f"{root}/out", f"{root}/checkpoint"


def _in_time_order(spark: SparkSession, sf_dir: str, batches: int = 3) -> Iterator[DataFrame]:
    """The events as a stream that grows by a slice of time before each of ``batches`` runs, so that state crosses runs."""
    path = f"{scratch_dir(spark, 'events')}/in.parquet"
    events = shapes.table(spark, sf_dir, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(at), F.max(at)).first()
    low, high = low or 0, high or 0
    place = F.least(F.lit(batches - 1), F.floor((at - low) * batches / (high - low + 1)))
    for k in range(batches):
        part = events.where(place == k) if k else events.where((place == 0) | place.isNull())
        part.write.mode("append").parquet(path)
        yield spark.readStream.schema(events.schema).parquet(path)


def score(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = _places(spark, "st-score")
    events = table_stream(spark, sf_dir, "events")
    flows.score_stream(
        shapes.topic_messages(events), shapes.routed, engineered_score, out, checkpoint, F.col("timestamp"), ("event_id",)
    )
    return spark.read.parquet(f"{out}/predictions").drop("batch_id")


def trained_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events scored by a saved model, the second half by a newer version that was published between two batches."""
    out, checkpoint = _places(spark, "st-model")
    models, source, features = f"{out}/models", f"{out}/source", list(ARM.readings)
    events = shapes.table(spark, sf_dir, "events")
    versions = serving.first_trees(complete(spark, sf_dir, ARM), features, (1, 5), 1.0)
    for k, model in enumerate(versions):
        serving.publish(spark, model, features, f"{models}/{ARM.name}")
        events.where(F.pmod("event_id", F.lit(2)) == k).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        served = serving.Served(spark, models, out)
        flows.score_stream(
            shapes.topic_messages(stream), shapes.routed, served.probability, out, checkpoint, F.col("timestamp"), ("event_id",), served.transform, served.begin
        )
    return spark.read.parquet(f"{out}/predictions").drop("batch_id")


def sensor_to_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = _places(spark, "st-lake")
    messages = shapes.sensor_messages(table_stream(spark, sf_dir, "events"), ARM)
    flows.lake_stream(messages, ARM, out, checkpoint, "event_id")
    return spark.read.parquet(out).drop("ingest_date")


def lake_to_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the lake stream staged, merged by the daily job into an empty lake and once more into the filled one."""
    out, checkpoint = _places(spark, "st-staged")
    messages = shapes.sensor_messages(table_stream(spark, sf_dir, "events"), ARM)
    flows.lake_stream(messages, ARM, out, checkpoint)
    for row in spark.read.parquet(out).select("ingest_date").distinct().collect():  # the days of this run, one or two
        day = run_day(str(row[0]))
        for _ in range(2):
            jobs.upsert_day(spark, out, f"{out}-lake", ARM, day)
    return spark.read.parquet(f"{out}-lake").drop(jobs.LAKE_PARTITION)


def cdc_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = _places(spark, "st-changes")
    flows.change_stream(shapes.change_messages(table_stream(spark, sf_dir, "events")), out, checkpoint, "event_id")
    return spark.read.parquet(out).withColumn("date", F.col("date").cast("string"))


def risk_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = _places(spark, "st-counts")
    for events in _in_time_order(spark, sf_dir):
        rows = flatten.sensor_rows(shapes.sensor_messages(events, ARM), ARM)
        flows.count_stream(score_rows(rows, ARM).where(F.col("risk_level").isNotNull()), out, checkpoint)
    counts = flows.current_counts(spark.read.parquet(out))
    return counts.withColumn("date", F.col("date").cast("string"))


def risk_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts as increments, of which every two runs of batches are merged."""
    out, checkpoint = _places(spark, "st-tally")
    for events in _in_time_order(spark, sf_dir):
        rows = flatten.sensor_rows(shapes.sensor_messages(events, ARM), ARM)
        flows.tally_stream(score_rows(rows, ARM).where(F.col("risk_level").isNotNull()), out, checkpoint, fan=2)
    return flows.tally(spark, out, fan=2).current().withColumn("date", F.col("date").cast("string"))


def prev_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = _places(spark, "st-previous")
    for events in _in_time_order(spark, sf_dir):
        rows = flatten.sensor_rows(shapes.sensor_messages(events, ARM), ARM, "event_id")
        flows.previous_stream(rows, ARM, out, checkpoint, "event_id", buckets=8)
    return spark.read.parquet(f"{out}/rows").drop("batch_id")


def star_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per document in every table written by the record stream, quarantine included."""
    out, checkpoint = _places(spark, "st-records")
    landed = f"{out}/landed"
    raw = shapes.service_records(spark, sf_dir)
    with shuffles_removed(spark):
        raw.write.options(**PACKED).parquet(landed)
    stream = spark.readStream.schema(raw.schema).parquet(landed)
    flows.record_stream(stream, out, checkpoint)
    parts = [
        spark.read.parquet(f"{out}/{name}").groupBy("doc_id").agg(F.count("*").alias("rows")).withColumn("table", F.lit(name))
        for name in (*STAR_TABLES, "error")
    ]
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    return total
