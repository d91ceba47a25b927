"""Give the benchmark tables the shape of the platform's inputs.

Expressions are SQL text that Spark and the reference database read alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefn import iso_text
from ..schemas import FAMILIES, Family
from .files import enough_parts, spread

K = "cast(get_json_object(props, '$.k') as int)"

# Event types as topics: which family each message belongs to.
ROUTES = {
    "arm_robot": ("click", "error"),
    "cnc_machine": ("view",),
    "injection_molding": ("purchase",),
    "battery_assembly": ("signup",),
}

STATUS = (
    "case event_type when 'error' then 'FAILURE' when 'signup' then 'MAINTENANCE_NEEDED' "
    "when 'purchase' then 'MAINTENANCE_PERFORMED' else 'NORMAL' end"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reading_sql(family: Family) -> dict[str, str]:
    """Value of each reading from ``value`` and ``k``. The first one is sometimes missing."""
    out = {}
    for j, name in enumerate(family.readings):
        if name == family.counter:
            out[name] = f"cast(k * 10 + {j} as int)"
        elif name.endswith("_wear_percent"):
            out[name] = "cast(k as double) - 5"
        elif j == 0:
            out[name] = "case when k < 99 then value + 100 end"
        elif j % 2:
            out[name] = f"cast(k as double) * {j + 1} / 10"
        else:
            out[name] = f"value * {j + 1}"
    return out


def _envelope(family: Family) -> Column:
    readings = F.struct(*[F.expr(sql).alias(name) for name, sql in reading_sql(family).items()])
    return F.to_json(
        F.struct(
            iso_text(F.col("ts")).alias("timestamp"),
            F.concat(F.lit("M-"), F.col("user_id")).alias("machine_id"),
            F.lit(family.machine_type).alias("machine_type"),
            readings.alias("readings"),
        )
    )


def sensor_messages(events: DataFrame, family: Family) -> DataFrame:
    """Events as JSON messages of one family: event_id, event_type, value."""
    rows = spread(events, "event_id").withColumn("k", F.expr(K))
    return rows.select("event_id", "event_type", _envelope(family).alias("value"))


def topic_messages(events: DataFrame) -> DataFrame:
    """Events as one mixed message stream, each in the shape of its topic's family, in one pass."""
    value = F.coalesce(
        *[F.when(F.col("event_type").isin(*ROUTES[f.name]), _envelope(f)) for f in FAMILIES.values()]
    )
    return events.withColumn("k", F.expr(K)).select("event_id", "event_type", value.alias("value"))


def routed(messages: DataFrame, family: Family) -> DataFrame:
    """Messages on the topic of one family."""
    return messages.where(F.col("event_type").isin(*ROUTES[family.name]))


def change_messages(events: DataFrame) -> DataFrame:
    """Events as change envelopes: event_id, value. Some are tombstones, some malformed."""
    k = spread(events, "event_id").withColumn("k", F.expr(K))
    row = F.struct(
        F.col("user_id").cast("int").alias("id"),
        F.col("event_type").alias("name"),
        F.col("k").alias("stock"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("created_at"),
    )
    kind = F.col("event_type")
    empty = (kind == "view") & (F.col("k") < 10)
    envelope = F.struct(
        F.when(~empty & (kind != "signup"), row).alias("before"),
        F.when(~empty & (kind != "error"), row).alias("after"),
    )
    text = F.to_json(envelope, {"ignoreNullFields": "false"})
    broken = (kind == "click") & (F.col("k") < 5)
    return k.select("event_id", F.when(broken, F.lit('{"before": nul')).otherwise(text).alias("value"))


def service_records(spark: SparkSession, sf_dir: str, faults: bool = False) -> DataFrame:
    """Order lines as service records: doc_id (order date), pos, raw.

    A line is one visit with up to two services and up to two parts. Arrays are
    built row by row, so no group is ever collected. ``faults`` adds records that
    break further rules.
    """

    def faulty(condition: Column, bad: Column, good: Column) -> Column:
        return F.when(condition, bad).otherwise(good.cast("string")) if faults else good

    null = F.lit(None).cast("string")
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    # lines come last: they are shuffled once, and not again by customer
    ordered = orders.join(customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")), F.col("o_custkey") == F.col("c_custkey"))
    # by the key of the join, so that few splits are spread and the join shuffles nothing again
    if parts := enough_parts(lines):
        lines, ordered = lines.repartition(parts, "l_orderkey"), ordered.repartition(parts, "o_orderkey")
    visits = lines.join(ordered, F.col("l_orderkey") == F.col("o_orderkey"))
    services = F.array_compact(
        F.array(
            F.when(
                F.col("l_tax") > 0,
                F.struct(
                    F.col("l_returnflag").alias("service_code"),
                    F.concat(F.lit("SVC-"), F.col("l_linestatus")).alias("service_name"),
                    F.col("l_tax").alias("service_cost"),
                    F.lit(None).cast("string").alias("technician_notes"),
                ),
            ),
            F.when(
                F.col("l_discount") > 0,
                F.struct(
                    F.lit(None).cast("string").alias("service_code"),
                    F.lit("SVC-CHECK").alias("service_name"),
                    F.col("l_discount").alias("service_cost"),
                    F.col("o_orderpriority").alias("technician_notes"),
                ),
            ),
        )
    )
    parts = F.array_compact(
        F.array(
            F.struct(
                F.concat(F.lit("P-"), F.col("l_partkey")).alias("part_code"),
                F.concat(F.lit("PART-"), F.col("l_partkey")).alias("part_name"),
                (F.col("l_quantity").cast("int") - (1 if faults else 0)).alias("quantity"),
                F.col("l_extendedprice").alias("unit_cost"),
            ),
            F.when(
                F.col("l_returnflag") == "R",
                F.struct(
                    F.lit(None).cast("string").alias("part_code"),
                    F.concat(F.lit("SEAL-"), F.col("l_suppkey")).alias("part_name"),
                    F.col("l_linenumber").alias("quantity"),
                    F.col("l_discount").alias("unit_cost"),
                ),
            ),
        )
    )
    record = F.struct(
        F.concat_ws("-", F.lit("SRV"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("service_record_id"),
        F.struct(
            faulty(F.col("c_nationkey") == 7, null, F.concat(F.lit("DLR-"), F.col("c_nationkey"))).alias("dealer_id"),
            F.col("n_name").alias("dealer_name"),
            F.concat(F.lit("REGION-"), F.col("n_regionkey")).alias("dealer_location"),
        ).alias("dealer"),
        F.struct(
            F.concat(F.lit("VIN-"), F.col("o_custkey")).alias("vin"),
            F.col("c_mktsegment").alias("model"),
            (F.col("o_custkey") % 30 + 1995).cast("int").alias("year"),
            faulty(F.col("o_orderpriority") == "1-URGENT", null, F.floor("o_totalprice").cast("int")).alias(
                "odometer_reading"
            ),
        ).alias("vehicle"),
        F.struct(
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("service_date"),
            F.col("o_orderpriority").alias("service_advisor_name"),
            faulty(F.col("c_mktsegment") == "MACHINERY", F.lit("n/a"), F.col("c_acctbal")).alias(
                "total_cost"
            ),
            services.alias("services_performed"),
            parts.alias("parts_used"),
        ).alias("service_details"),
        F.struct(
            F.concat(F.lit("CUST-"), F.col("c_custkey")).alias("customer_id"),
            F.col("c_name").alias("customer_name"),
        ).alias("customer"),
    )
    return visits.select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("doc_id"),
        record_position().alias("pos"),
        F.to_json(record, {"ignoreNullFields": "false"}).alias("raw"),
    )


def record_position() -> Column:
    """Place of a record in its document: by order, line, part, supplier, then the rest of the line."""
    columns = (
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_shipdate",
        "l_extendedprice",
        "l_quantity",
        "l_discount",
        "l_tax",
    )
    return F.struct(*columns)


def labelled_history(events: DataFrame, family: Family) -> DataFrame:
    """Flat history of one family with status and time since maintenance."""
    k = events.withColumn("k", F.expr(K))
    return k.select(
        "event_id",
        iso_text(F.col("ts")).alias("timestamp"),
        F.concat(F.lit("M-"), F.col("user_id")).alias("machine_id"),
        F.lit(family.machine_type).alias("machine_type"),
        *[F.expr(sql).alias(name) for name, sql in reading_sql(family).items()],
        F.expr(STATUS).alias("status"),
        F.expr("cast(event_id * 7 % 100 as double)").alias("time_since_maintenance"),
    )
