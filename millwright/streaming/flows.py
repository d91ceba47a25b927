"""Streaming flows: sources in, tables out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from ..functions import timefn
from ..operators import changes, features, flatten, marts, quality, scoring, star
from ..operators.previous import TARGET_ROWS, slices
from ..schemas import FAMILIES, Family
from ..session import PACKED, delete, scratch_dir, shuffles_removed, written
from .runs import Runs
from .sinks import parquet_stream, run_to_end, write_batch

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


Run = Callable[[DataStreamWriter, str], None]  # how a query is run: sinks.run_to_end, or what sinks.at_interval gives
STATE_BUCKETS = 64


def _each_batch(df: DataFrame, checkpoint: str, work: Callable[[DataFrame, int], None], run: Run = run_to_end) -> None:
    """Run ``work`` on every micro-batch, reading its input once."""

    def step(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            work(kept, batch_id)
        finally:
            kept.unpersist()

    run(df.writeStream.foreachBatch(step), checkpoint)


def score_stream(
    messages: DataFrame,
    route: Callable[[DataFrame, Family], DataFrame],
    probability: Callable[[Family], Column],
    out: str,
    checkpoint: str,
    at: Column | None = None,
    keep: tuple[str, ...] = (),
    transform: Callable[[DataFrame, Family], DataFrame] | None = None,
    begin: Callable[[int], None] | None = None,
    run: Run = run_to_end,
) -> None:
    """Score every family's messages in one query, on the features a model is trained on; unusable messages go whole
    to ``rejects``.

    ``route`` picks the messages of a family. ``probability`` is a column over the feature frame, or over what
    ``transform`` makes of it; ``serving.Served`` has both for trained models, and ``begin``, which is called with the
    number of each batch first. ``at`` is the prediction time, by default the processing time.
    """
    moment = timefn.iso_text(F.current_timestamp()) if at is None else at

    def work(batch: DataFrame, batch_id: int) -> None:
        good, bad = [], []
        if begin:
            begin(batch_id)
        for family in FAMILIES.values():
            mine = route(batch, family)
            rows = flatten.sensor_rows(mine, family, *keep, "value")
            framed = features.serving_features(rows, family, *keep, "value", "timestamp", "machine_id", "machine_type")
            framed = transform(framed, family) if transform else framed
            rows = scoring.risk_rows(framed, probability(family), moment, *keep, "value")
            good.append(scoring.accepted(rows).drop("value"))
            bad.append(flatten.sensor_rejects(mine, family, *keep).withColumn("reason", F.lit("malformed")))
            bad.append(scoring.unscored(rows).select(*keep, "value", F.lit("no_score").alias("reason")))
        write_batch(scoring.union_families(good, *keep), f"{out}/predictions", batch_id)
        rejects = bad[0]
        for more in bad[1:]:
            rejects = rejects.unionByName(more)
        write_batch(rejects, f"{out}/rejects", batch_id)

    _each_batch(messages, checkpoint, work, run)


def lake_stream(messages: DataFrame, family: Family, out: str, checkpoint: str, *keep: str) -> None:
    """Flatten messages into a staging folder per processing date; malformed ones go whole to ``<out>_rejects``."""
    today = F.date_format(F.current_timestamp(), timefn.DAY_COMPACT)
    rows = flatten.sensor_rows(messages, family, *keep).withColumn("ingest_date", today)
    run_to_end(parquet_stream(rows, out, "ingest_date"), checkpoint)
    rejects = flatten.sensor_rejects(messages, family, *keep).withColumns({"reason": F.lit("malformed"), "ingest_date": today})
    run_to_end(parquet_stream(rejects, f"{out}_rejects", "ingest_date"), f"{checkpoint}_rejects")


def change_stream(messages: DataFrame, out: str, checkpoint: str, *keep: str) -> None:
    """Classified change log, every row in the partition of its own date; the rest goes whole to ``<out>_rejects``."""
    rows = changes.with_change_date(changes.classify_changes(messages, *keep))
    run_to_end(parquet_stream(rows, out, "date"), checkpoint)
    run_to_end(parquet_stream(changes.rejected_changes(messages, *keep), f"{out}_rejects", "reason"), f"{checkpoint}_rejects")


def count_stream(predictions: DataFrame, out: str, checkpoint: str) -> None:
    """Running daily risk counts: each batch writes the counts that changed."""
    counts = marts.daily_risk_counts(predictions)

    def work(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, out, batch_id)

    # Counts live on local disk with change logs in the checkpoint, not on the heap.
    conf = predictions.sparkSession.conf
    before = conf.get(STATE_STORE, None)
    conf.set(STATE_STORE, ROCKSDB)
    try:
        run_to_end(counts.writeStream.outputMode("update").foreachBatch(work), checkpoint)
    finally:
        conf.unset(STATE_STORE) if before is None else conf.set(STATE_STORE, before)


def current_counts(changed: DataFrame) -> DataFrame:
    """Latest count per key of what ``count_stream`` wrote."""
    return changed.groupBy(*marts.RISK_KEYS).agg(F.max_by("risk_count", "batch_id").alias("risk_count"))


def tally(spark: SparkSession, out: str, fan: int = 8) -> Runs:
    """The daily risk counts that ``tally_stream`` keeps below ``out``."""
    schema = StructType.fromDDL("date date, machine_type string, machine_id string, risk_level string, risk_count bigint")
    return Runs(spark, out, schema, "date", marts.summed_counts, fan)


def tally_stream(predictions: DataFrame, out: str, checkpoint: str, fan: int = 8, run: Run = run_to_end) -> None:
    """Daily risk counts as increments: a batch writes the counts of its own rows only, and counts are merged by and by.

    A read takes a few folders, whatever the number of batches, and no count is held in the stream.
    """
    counts = tally(predictions.sparkSession, out, fan)

    def work(batch: DataFrame, batch_id: int) -> None:
        counts.add(marts.daily_risk_counts(batch), batch_id)

    run(predictions.writeStream.foreachBatch(work), checkpoint)


def previous_stream(
    rows: DataFrame,
    family: Family,
    out: str,
    checkpoint: str,
    *tie: str,
    target_rows: int = TARGET_ROWS,
    buckets: int = STATE_BUCKETS,
    run: Run = run_to_end,
) -> None:
    """Serving features with the previous reading carried across micro-batches.

    State is one row per machine, in buckets by machine: a batch writes the machines it has, and reads
    the buckets of these. Inside a batch the look back runs over time slices, so a machine that fills a batch does
    not end up in one task. An older reading never replaces a newer one in the state.
    """
    spark = rows.sparkSession
    carried = features.machine_seeds(spark.createDataFrame([], rows.schema), family, *tie).schema

    def newest(states: DataFrame) -> DataFrame:
        rest = [c for c in states.columns if c != "machine_id"]
        one = states.groupBy("machine_id").agg(F.max_by(F.struct(*rest), F.struct("_at", *tie)).alias("r"))
        return one.select("machine_id", "r.*")

    state = Runs(spark, f"{out}/state", carried, "machine_id", newest, buckets=buckets)

    def work(batch: DataFrame, batch_id: int) -> None:
        ts = timefn.parse_ts(F.col("timestamp")).cast("timestamp")
        latest = features.machine_seeds(batch, family, *tie)
        seeds = state.before(batch_id, latest)
        if seeds is not None:
            seeds = seeds.persist(StorageLevel.MEMORY_AND_DISK)  # one row per machine of the batch, read several times
        try:
            cut = slices(batch, "machine_id", ts, tie, target_rows, seeds)
            write_batch(features.serving_history(batch, family, cut, *tie, seeds=seeds), f"{out}/rows", batch_id)
            state.add(latest, batch_id)
        finally:
            if seeds is not None:
                seeds.unpersist()

    _each_batch(rows, checkpoint, work, run)


def record_stream(records: DataFrame, out: str, checkpoint: str) -> None:
    """Landed documents to star tables, items and quarantine; a document arrives whole in one batch.

    Texts of items and quarantine are read from the batch again, so that they aren't written beside what was parsed.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        # written, not held: a batch may be larger than the executors' memory
        scratch = scratch_dir(batch.sparkSession, "parsed")
        texts = batch.select("doc_id", "pos", "raw")
        try:
            with shuffles_removed(batch.sparkSession):
                parsed = written(quality.judged(quality.parse_records(batch), *star.ALL_READS), "parsed", scratch, **PACKED)
                verdicts = quality.settle(quality.judge_documents(parsed))
                for name, table in star.star_tables(quality.accept(parsed, verdicts)).items():
                    write_batch(table, f"{out}/{name}", batch_id)
                write_batch(quality.accept(texts, verdicts), f"{out}/items", batch_id, **PACKED)
                write_batch(quality.reject(texts, verdicts).select("doc_id", "pos", "raw", "rule"), f"{out}/error", batch_id, **PACKED)
        finally:
            delete(batch.sparkSession, scratch)

    run_to_end(records.writeStream.foreachBatch(work), checkpoint)
