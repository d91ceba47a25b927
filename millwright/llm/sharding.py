"""Sharding by extendible hashing, in DataFrame functions only.

A directory indexed by hash-prefix bits says which shard a row belongs to. All rows start in one bucket; a
bucket over the byte limit is split on the next bit of the hash, and only such a bucket, until every shard fits.

The splits of several levels are found at once. Bytes are summed per slot, a prefix a few bits longer than an
even split would need; these sums are added up to every shorter prefix, and the shards are the shortest prefixes
that fit. Slots that are still too large go through another pass over their rows alone. Rows of one hash can't
be told apart by bits: when the bits are used up, such a bucket is cut by running bytes in scan order.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright.session import written

BITS, SPARE_BITS, LIMIT = 60, 4, 16 << 20
_SHARD = ["depth", "prefix", "shard_bytes", "shard_rows"]


def hashed(key: Column) -> Column:
    """The first 60 bits of the MD5 of the key as text; null counts as the empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("bigint")


def _slots(rows: DataFrame, base: int, deep: int, limit: int, bits: int) -> DataFrame:
    """(slot, depth, prefix, shard_bytes, shard_rows) of a pass over the levels base to deep; no shard: null depth."""
    slots = rows.groupBy(F.expr(f"shiftright(hash, {bits - deep})").alias("slot")).agg(
        F.sum("bytes").alias("shard_bytes"), F.count("*").alias("shard_rows")
    )
    slots = written(slots, "slots")
    levels = slots.withColumn("depth", F.explode(F.sequence(F.lit(base), F.lit(deep)))).withColumn(
        "prefix", F.expr(f"shiftright(slot, {deep} - depth)")
    )
    sums = levels.groupBy("depth", "prefix").agg(F.sum("shard_bytes").alias("shard_bytes"), F.sum("shard_rows").alias("shard_rows"))
    fits = sums.where(f"shard_bytes <= {limit}" + (f" or depth = {bits}" if deep == bits else ""))
    # along the prefixes of a slot sizes only shrink, so its shard is the shortest prefix that fits
    best = levels.select("slot", "depth", "prefix").join(fits, ["depth", "prefix"]).groupBy("slot").agg(F.min(F.struct(*_SHARD)).alias("s"))
    return written(slots.select("slot").join(best, "slot", "left").select("slot", "s.*"), "directory")


def _pieces(rows: DataFrame, limit: int) -> DataFrame:
    """Buckets of one hash over the limit, cut into pieces: large rows alone, others by half limits of running bytes."""
    half = limit // 2
    rows = rows.withColumn("part", F.expr("shiftright(_at, 33)"))
    small, large = rows.where(f"bytes <= {half}"), rows.where(f"bytes > {half}")
    sums = small.groupBy("prefix", "part").agg(F.sum("bytes").alias("sum"))
    before = Window.partitionBy("prefix").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per scan task
    sums = sums.select("prefix", "part", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("before"))
    run = Window.partitionBy("prefix", "part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("bytes").over(run), F.lit(0))
    cut = small.join(sums, ["prefix", "part"]).withColumn("piece", F.floor(start / F.lit(half)).cast("bigint")).drop("before")
    both = cut.unionByName(large.withColumn("piece", -1 - F.col("_at")))
    size = both.groupBy("prefix", "piece").agg(F.sum("bytes").alias("shard_bytes"), F.count("*").alias("shard_rows"))
    return both.drop("part", "shard_bytes", "shard_rows").join(size, ["prefix", "piece"])


def assign(rows: DataFrame, limit: int = LIMIT, bits: int = BITS) -> DataFrame:
    """``rows`` (columns hash, bytes and any others) with shard, shard_bytes and shard_rows.

    hash has ``bits`` bits. shard is the prefix as zeros and ones; where one hash is over the limit, a point and a
    piece follow. A shard holds at most ``limit`` bytes or one row. Rows above the limit are set apart at the start
    as shards of their own (``row`` and a number). Null bytes count as 0. Every row gives one row.
    """
    rows = rows.withColumn("bytes", F.coalesce(F.col("bytes").cast("bigint"), F.lit(0).cast("bigint")))
    rows = written(rows.withColumn("_at", F.monotonically_increasing_id()), "shard-rows")
    todo = rows.where(f"bytes <= {limit}")
    total = todo.agg(F.sum("bytes")).first()[0] or 0
    base, deep = 0, min(bits, max(0, ceil(log2(max(1, total / limit)))) + SPARE_BITS)
    done: list[DataFrame] = []
    while True:
        slots = _slots(todo, base, deep, limit, bits)
        placed = todo.withColumn("slot", F.expr(f"shiftright(hash, {bits - deep})")).join(slots, "slot").drop("slot")
        done.append(placed.where("depth is not null"))
        if deep == bits or not slots.where("depth is null").limit(1).count():
            break
        todo = written(placed.where("depth is null").drop(*_SHARD), "shard-rows")
        base, deep = deep + 1, min(bits, deep + 2 * SPARE_BITS)
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    named = F.when(F.col("depth") == 0, "").otherwise(F.expr("lpad(bin(prefix), depth, '0')"))
    whole = found.withColumn("shard", named)
    if deep == bits:
        cut = _pieces(found.where(f"depth = {bits} and shard_bytes > {limit}"), limit)
        cut = cut.withColumn("shard", F.concat(named, F.lit("."), F.col("piece").cast("string"))).drop("piece")
        whole = whole.where(f"depth < {bits} or shard_bytes <= {limit}").unionByName(cut)
    alone = rows.where(f"bytes > {limit}").withColumns(
        {"shard": F.concat(F.lit("row"), F.col("_at").cast("string")), "shard_bytes": F.col("bytes"), "shard_rows": F.lit(1).cast("bigint")}
    )
    return whole.drop("depth", "prefix").unionByName(alone).drop("_at")


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT, key: str = "doc_id") -> None:
    """``docs`` as Parquet, one folder per shard; no task holds more than the shards that hash to it."""
    from millwright.llm.common import ROW, with_row_id

    rows = with_row_id(docs)
    sized = rows.select(ROW, hashed(F.col(key)).alias("hash"), F.octet_length(F.coalesce("text", F.lit(""))).alias("bytes"))
    shards = assign(sized, limit).select(ROW, "shard")
    rows.join(shards, ROW).drop(ROW).repartition("shard").write.partitionBy("shard").parquet(path)
