"""Queries on service records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text, timefn
from ..operators import items, quality, star
from ..schemas import STAR_TABLES
from ..session import PACKED, scratch_dir, shuffles_removed, written
from ..sources import files, shapes
from . import jobs, ledger


def records(spark: SparkSession, sf_dir: str, faults: bool = False) -> DataFrame:
    return quality.parse_records(shapes.service_records(spark, sf_dir, faults), as_text=faults)


def accepted(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Accepted records: doc_id, pos, vin and ``columns``, written beside what the verdict needs, so that texts are parsed once."""
    rows = written(quality.judged(records(spark, sf_dir), *columns), "judged")
    return quality.accept(rows, quality.settle(quality.judge_documents(rows)))


def star_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return star.BUILDERS[table](accepted(spark, sf_dir, *star.READS[table]))


def star_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = star_table(spark, sf_dir, "fact_service_records")
    shown = {c: F.date_format(c, timefn.SECONDS) for c in ("service_datetime_utc", "service_datetime_wib")}
    return fact.withColumns(shown)


def star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cost per dealer from the joined star; three tables are made of the accepted records."""
    used = dict.fromkeys(c for table in ("fact_service_records", "dim_dealer", "dim_customer") for c in star.READS[table])
    rows = accepted(spark, sf_dir, *used)
    joined = star.star_join(star.fact_service_records(rows), star.dim_dealer(rows), star.dim_customer(rows))
    return joined.groupBy("dealer_name").agg(
        F.count("*").alias("records"),
        F.countDistinct("customer_name").alias("customers"),
        F.round(F.sum("total_cost"), 2).alias("total_cost"),
    )


def parts_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = star_table(spark, sf_dir, "dim_parts_used")
    return parts.groupBy("doc_id").agg(F.sum("quantity").alias("quantity"), F.count("*").alias("parts"))


def two_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = shapes.table(spark, sf_dir, "orders")
    at = timefn.parse_ts(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return orders.select(
        "o_orderkey",
        F.date_format(at, timefn.SECONDS).alias("utc"),
        F.date_format(timefn.local_wall_clock(at), timefn.SECONDS).alias("local"),
    )


def violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.violation_counts(records(spark, sf_dir, faults=True))


def accept_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_documents(records(spark, sf_dir))


def first_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_documents(records(spark, sf_dir, faults=True))


def posted_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge_posted(records(spark, sf_dir, faults=True))
    return judged.select("doc_id", "records", F.col("rule").isNull().cast("int").alias("accepted"))


def kv_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = shapes.service_records(spark, sf_dir)
    last = items.last_record_per_key(raw, "service_record_id", "doc_id", "pos")
    kept = items.item_rows(last, "service_record_id")
    details = F.col("item.service_details")
    return kept.select(
        "service_record_id",
        details["total_cost"][items.NUMBER].cast("decimal(38,10)").alias("total_cost"),
        F.size(details["services_performed"]).alias("services"),
        F.size(details["parts_used"]).alias("parts"),
        details["parts_used"][0]["unit_cost"][items.NUMBER].cast("decimal(38,10)").alias("first_unit_cost"),
    )


def exact_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of every magnitude through the text that items carry, and back: nothing is rounded, nothing overflows."""
    price = F.col("l_extendedprice").cast("double")
    figures = {"plain": price, "seventh": price / 7, "tiny": price / 7 * 1e-20, "huge": price / 7 * 1e30}
    lines = shapes.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[f.alias(n) for n, f in figures.items()]
    )
    kept = items.floats_to_decimals(lines)
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[F.col(f"{n}.{items.NUMBER}").cast("double").alias(n) for n in figures])


def ingest_to_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posted batches through landing files and the processor, in two calls of which the second is repeated.

    Some records come without parts, which ingest fills. A batch is a day of orders, landed under the first of its year.
    """
    root = scratch_dir(spark, "ingest")
    raw = shapes.service_records(spark, sf_dir).withColumn("date", F.concat(F.substring("doc_id", 1, 4), F.lit("-01-01")))
    bare = F.regexp_replace("raw", r',"parts_used":\[[^\]]*\]', "")
    raw = raw.withColumn("raw", F.when(F.col("raw").contains('"service_advisor_name":"1-URGENT"'), bare).otherwise(F.col("raw")))
    jobs.land_posted(raw, f"{root}/landed")
    documents = written(files.documents(spark, f"{root}/landed"), "documents", **PACKED)
    early = files.doc_date(F.col("doc_id")) < "1995-01-01"
    for part in (documents.where(early), documents.where(~early), documents.where(~early)):
        jobs.process_documents(part, f"{root}/out", buckets=1)
    counts = [
        spark.read.schema("doc_id string, date string").parquet(f"{root}/out/{text.ANALYTICS}{name}").groupBy("date").agg(F.count("*").alias("rows")).withColumn("table", F.lit(name))
        for name in STAR_TABLES
    ]
    for name, folder in (("items", text.ITEMS), ("error", text.ERRORS)):
        kept = spark.read.schema("doc_id string, date string").json(f"{root}/out/{folder}")
        counts.append(kept.groupBy("date").agg(F.count("*").alias("rows")).withColumn("table", F.lit(name)))
    total = counts[0]
    for more in counts[1:]:
        total = total.unionByName(more)
    return total.select("table", F.col("date").cast("string").alias("date"), "rows")


def document_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per document in all eight outputs after four calls with overlapping, repeated, changed and newly rejected documents.

    Documents of July lose their vehicles in the second call, those of September lose them first and get them back, those
    of March keep only the first two lines of an order. The years 1995 and 1996 are sent unchanged in two calls.
    """
    root = f"{scratch_dir(spark, 'commits')}/out"
    month, year = F.substring("doc_id", 6, 2), F.substring("doc_id", 1, 4)
    with shuffles_removed(spark):
        raw = written(shapes.service_records(spark, sf_dir), "records", **PACKED)
    broken = F.regexp_replace("raw", '"vin":"[^"]*"', '"vin":null')
    named = lambda rows: rows.withColumn("doc_id", F.concat(F.lit("date="), year, F.lit("-01-01/"), F.col("doc_id")))
    faulty = lambda m: F.when(month == m, broken).otherwise(F.col("raw"))
    calls = [
        raw.where(year < "1997").withColumn("raw", faulty("09")),
        raw.where((year >= "1995") & (month != "09")),
        raw.where((month == "03") & (F.col("pos.l_linenumber") <= 2)),
        raw.where(month.isin("07", "09")).withColumn("raw", faulty("07")),
    ]
    for call in (*calls, calls[2]):
        jobs.process_documents(named(call), root, buckets=1)
    outputs = {name: ("parquet", f"{text.ANALYTICS}{name}") for name in STAR_TABLES} | {"items": ("json", text.ITEMS), "error": ("json", text.ERRORS)}
    counts = [
        spark.read.format(kind).schema("doc_id string").load(f"{root}/{folder}").groupBy("doc_id").agg(F.count("*").alias("rows")).withColumn("table", F.lit(name))
        for name, (kind, folder) in outputs.items()
    ]
    kept = ledger.entries(spark, root).select("doc_id", F.col("records").alias("rows"), F.lit("ledger").alias("table"))
    return reduce(DataFrame.unionByName, counts, kept)


def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = shapes.table(spark, sf_dir, "orders")
    sent = orders.select(
        "o_orderkey",
        F.concat(
            F.lit("service-records%2Fdate%3D"),
            F.date_format("o_orderdate", timefn.DAY_DASHED),
            F.lit("%2F"),
            F.col("o_orderkey"),
            F.lit("+a.json"),
        ).alias("sent"),
        F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" ")).alias("label"),
    ).withColumn("key", text.decoded_key(F.col("sent")))
    key = F.col("key")
    return sent.select(
        "o_orderkey",
        "key",
        text.analytics_path(key, "dim_dealer").alias("analytics"),
        text.items_path(key).alias("items"),
        text.error_path(key).alias("error"),
        key.endswith(".json").cast("int").alias("is_json"),
        F.trim("label").alias("label"),
        F.col("label").contains("HIGH").cast("int").alias("is_high"),
    )
