"""Previous reading per machine, without putting one machine's history into one task.

A plain window over ``machine_id`` sends all rows of a machine to a single task.
Here the history of a busy machine is cut into time slices of about equal size. The window runs inside (machine, slice),
and the last row of each slice is handed over to the machine's next slice as one
extra seed row. The hand-over table holds one row per non-empty slice, so the
only per-machine window is over that small table.
"""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written

HOUR = 3_600_000_000
DAY = 24 * HOUR
TARGET_ROWS = 1_000_000
Cut = int | DataFrame | None
_LEAST = -(1 << 62)
_TIME_STEPS, _TIE_STEPS = (25, 13, 0), (52, 40, 28, 16, 4, 0)  # bits left aside, coarse to fine: of a day's microseconds, of a tie


def slice_micros(df: DataFrame, key: str, ts: Column, target_rows: int = TARGET_ROWS) -> int:
    """Slice width that keeps the busiest (key, slice) near ``target_rows``.

    One aggregate over two columns; a single number comes back.
    """
    hourly = df.groupBy(F.col(key), F.floor(F.unix_micros(ts) / F.lit(HOUR)).alias("hour")).count()
    peak = hourly.agg(F.max("count")).first()[0] or 0
    if peak > target_rows:
        return max(1, HOUR // -(-peak // target_rows))
    daily_rows = max(1, peak) * 24
    return HOUR * 24 if daily_rows <= target_rows else HOUR


def _codes(df: DataFrame, ts: Column, tie: Sequence[str]) -> dict[str, Column]:
    """Two numbers that never fall as (``ts``, ``tie``) rises: the time, and the first column of the tie."""
    micros = F.coalesce(F.unix_micros(ts.cast("timestamp")), F.lit(_LEAST))
    first, number = F.col(tie[0]), F.lit(0)
    kind = df.schema[tie[0]].dataType
    if isinstance(kind, T.IntegralType):
        number = first.cast("bigint")
    elif isinstance(kind, T.StringType):
        number = F.conv(F.rpad(F.hex(F.substring(first.cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("bigint")
    return {"_m": micros, "_t": F.coalesce(number, F.lit(_LEAST)).cast("bigint")}


def slices(
    df: DataFrame, key: str, ts: Column, tie: Sequence[str], target_rows: int = TARGET_ROWS, seeds: DataFrame | None = None
) -> DataFrame | None:
    """(k, day, starts): where the slices of the busy machines begin, for ``with_previous``; None if no machine is busy.

    A machine with at most ``target_rows`` rows is one slice. The rows of a busier one are counted in bins of time: by day,
    and again by finer bins, down to the microsecond and then to the tie, wherever a bin holds over half the target. Bins
    in order are then put together to slices of at most ``target_rows`` each. Only the rows of such bins are read again.
    """
    rows = df.select(F.col(key).alias("k"), *[c.alias(n) for n, c in _codes(df, ts, tie).items()])
    if seeds is not None:
        rows = rows.unionByName(seeds.select(F.col(key).alias("k"), *[c.alias(n) for n, c in _codes(seeds, F.col("_at"), tie).items()]))
    rows = rows.where("k is not null")
    if rows.groupBy("k").count().where(F.col("count") > target_rows).isEmpty():
        return None
    rows = rows.withColumn("day", F.floor(F.col("_m") / F.lit(DAY)))
    half = max(1, target_rows // 2)
    days = written(rows.groupBy("k", "day").agg(F.count("*").alias("n")), "days")
    busy = days.groupBy("k").agg(F.sum("n").alias("total")).where(F.col("total") > target_rows).select("k")
    days = written(days.join(busy, "k"), "busy-days")
    low = F.lit(_LEAST)
    done = [days.where(F.col("n") <= half).select("k", "day", (F.col("day") * DAY).alias("m"), low.alias("t"), "n")]
    full = days.where(F.col("n") > half).select("k", "day")
    todo = written(rows.join(full, ["k", "day"]), "full-days") if not full.isEmpty() else None
    offset = F.col("_m") - F.col("day") * DAY
    steps = [(F.shiftright(offset, s), s, True) for s in _TIME_STEPS] + [(F.shiftright("_t", s), s, False) for s in _TIE_STEPS]
    for k, (bin_of, shift, by_time) in enumerate(steps):
        if todo is None:
            break
        group = ["k", "day", "bin"] if by_time else ["k", "day", "_m", "bin"]
        todo = todo.withColumn("bin", bin_of)
        bins = written(todo.groupBy(*group).agg(F.count("*").alias("n")), "bins")
        start = F.shiftleft("bin", shift)
        at = [(F.col("day") * DAY + start).alias("m"), low.alias("t")] if by_time else [F.col("_m").alias("m"), start.alias("t")]
        whole = F.lit(True) if k == len(steps) - 1 else F.col("n") <= half  # equal times and ties can't be told apart
        done.append(bins.where(whole).select("k", "day", *at, "n"))
        full = bins.where(~whole).select(*group)
        todo = written(todo.join(full, group).drop("bin"), "full-bins") if not full.isEmpty() else None
    before = Window.partitionBy("k").orderBy("m", "t").rowsBetween(Window.unboundedPreceding, -1)  # over bins, not rows
    every = reduce(DataFrame.unionByName, done)
    every = every.withColumn("slice", F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / F.lit(half)))
    starts = every.groupBy(F.col("k"), F.col("day")).agg(F.array_sort(F.collect_list(F.struct("m", "t", "slice"))).alias("starts"))
    return written(starts, "slices")


def _sliced(rows: DataFrame, key: str, at: DataFrame, tie: Sequence[str]) -> DataFrame:
    """``rows`` with the number of their slice; machines that ``at`` doesn't list have one."""
    coded = rows.withColumns(_codes(rows, F.col("_at"), tie)).withColumn("_day", F.floor(F.col("_m") / F.lit(DAY)))
    coded = coded.join(at.select(F.col("k").alias("_k"), F.col("day").alias("_d"), "starts"), (F.col(key) == F.col("_k")) & (F.col("_day") == F.col("_d")), "left")
    begun = lambda s: (s["m"] < F.col("_m")) | ((s["m"] == F.col("_m")) & (s["t"] <= F.col("_t")))
    number = F.array_max(F.transform(F.filter("starts", begun), lambda s: s["slice"]))
    return coded.withColumn("_slice", F.coalesce(number, F.lit(0))).drop("_m", "_t", "_day", "_k", "_d", "starts")


def with_previous(
    df: DataFrame,
    key: str,
    ts: Column,
    tie: Sequence[str],
    columns: Sequence[str],
    width: Cut = None,
    seeds: DataFrame | None = None,
) -> DataFrame:
    """Add struct ``previous`` holding ``columns`` of the machine's preceding row.

    Order is (``ts``, ``tie``). ``previous`` is null on the first row. ``seeds``
    may hold one earlier row per machine (``key``, ``_at``, ``tie``, ``columns``).
    Rows without a machine have no previous row. ``width`` says how histories are cut: a number of microseconds, or the
    ``slices`` of these rows (and seeds); None leaves every history whole.
    """
    at = ts.cast("timestamp")
    rows = df.withColumn("_at", at).withColumn("_seed", F.lit(False))
    if seeds is not None:
        rows = rows.unionByName(seeds.withColumn("_seed", F.lit(True)), allowMissingColumns=True)
    if isinstance(width, int):
        rows = rows.withColumn("_slice", F.floor(F.unix_micros("_at") / F.lit(width)))
    else:
        rows = rows.withColumn("_slice", F.lit(0).cast("bigint")) if width is None else _sliced(rows, key, width, tie)
    # Rows without a machine need no look back; a hash keeps them from gathering in one slice.
    rows = rows.withColumn("_slice", F.when(F.col(key).isNull(), F.xxhash64("_at", *tie)).otherwise(F.col("_slice")))

    order = ["_at", *tie]
    carried = [*order, *columns]
    if width is not None:
        last = rows.where(F.col(key).isNotNull()).groupBy(key, "_slice").agg(
            F.max_by(F.struct(*carried), F.struct(*order)).alias("_last")
        )
        handed = (
            last.withColumn("_slice", F.lead("_slice").over(Window.partitionBy(key).orderBy("_slice")))
            .where(F.col("_slice").isNotNull())
            .select(key, "_slice", *[F.col(f"_last.{c}").alias(c) for c in carried], F.lit(True).alias("_seed"))
        )
        rows = rows.unionByName(handed, allowMissingColumns=True)
    window = Window.partitionBy(key, "_slice").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    before = F.lag(F.struct(*columns)).over(window)
    looked_back = rows.withColumn("previous", F.when(F.col(key).isNotNull(), before))
    return looked_back.where(~F.col("_seed")).drop("_at", "_seed", "_slice")
