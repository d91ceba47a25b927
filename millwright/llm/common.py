"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.session import written

ROW = "_row_id_"
SLICE_BYTES = 4 << 20
_FILE, _FIRST, _IN_FILE = "_file_", "_first_", 40  # bits of a row's place in its file


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_row_id(df: DataFrame) -> DataFrame:
    """``df`` with a number that tells repeated rows apart; ``df`` must be a plain scan, so that reruns number alike."""
    return df.withColumn(ROW, F.monotonically_increasing_id())


def numbered(df: DataFrame, *columns: str) -> DataFrame:
    """``columns`` (all by default) of ``df`` with a number per row that stays the same however often they are read.

    Rows of a plain Parquet scan are numbered by file and place in the file, which don't depend on how Spark splits
    files. Any other frame is written with its numbers and read again.
    """
    columns = columns or tuple(df.columns)
    if df._jdf.queryExecution().analyzed().nodeName() != "LogicalRelation" or "_metadata" in df.columns:
        return written(with_row_id(df.select(*columns)), "numbered")
    place = df.select(*columns, F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.row_index").alias(ROW))
    # one row per file; Spark's driver lists the files anyway
    files = sorted(r[0] for r in df.select("_metadata.file_path").distinct().collect())
    first = df.sparkSession.createDataFrame([(f, i << _IN_FILE) for i, f in enumerate(files)], f"{_FILE} string, {_FIRST} bigint")
    return place.join(F.broadcast(first), _FILE).select(*columns, (F.col(_FIRST) + F.col(ROW)).alias(ROW))


def text_slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut by running bytes of a column of strings or lists: a slice holds ``limit`` bytes, or one value.

    Memory follows one long text, not many; where long texts stand together, each slice holds few of them.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column)
        lists = pa.types.is_list(values.type) or pa.types.is_large_list(values.type)
        sizes = pc.multiply(pc.list_value_length(values), 8) if lists else pc.binary_length(values)
        ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


byte_slices = text_slices


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def arrow_type(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[name].dataType)


def field_ddl(df: DataFrame, names: Iterable[str]) -> str:
    return ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names)
