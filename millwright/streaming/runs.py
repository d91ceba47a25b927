"""State of a stream as runs of batches: every batch adds what it changed, and runs are merged now and then.

A batch writes one folder with its own rows. ``fan`` neighbouring runs of one size are merged into one, so the number
of folders grows with the logarithm of the number of batches, and a row is rewritten once per size. The value of a key
is what ``merge`` makes of its rows in all runs; ``merge`` must not care how rows are grouped into runs.

A batch sees and merges the batches before it only. Those are committed, so a batch that is run again finds the state
it found the first time, and replaces its own folder. A merged folder appears by one rename; the folders it replaces
are removed by the next batch, when no reader of the batch before uses them any more.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import delete, folders, replace_folder

BUCKET = "_bucket"
_DIGITS = 12


class Runs:
    """Rows by ``key``, kept as runs of batches below ``root``.

    With ``buckets``, the rows of a run lie in folders by hash of the key, and ``before`` reads those of the keys asked
    for. The number of buckets must not change for a root.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: StructType,
        key: str,
        merge: Callable[[DataFrame], DataFrame],
        fan: int = 8,
        buckets: int = 0,
    ):
        if fan < 2:
            raise ValueError("at least two runs are merged")
        self.spark, self.root, self.key, self.merge, self.fan, self.buckets = spark, root, key, merge, fan, buckets
        self.schema = StructType([*schema.fields]).add(BUCKET, "integer") if buckets else schema

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """Merge what earlier batches left to merge, then write the rows of this batch in place of any it wrote before."""
        self._tidy(batch_id)
        self._write(rows, batch_id, batch_id)

    def before(self, batch_id: int, keys: DataFrame | None = None) -> DataFrame | None:
        """One row per key as the batches before ``batch_id`` left it, or None at the start.

        With ``keys``, a frame with the key column, only the state of its keys, from their buckets.
        """
        found = self._read(self._cover(batch_id))
        if found is None:
            return None
        if keys is not None:
            wanted = keys.select(self.key).distinct()
            if self.buckets:
                touched = [r[0] for r in wanted.select(self._bucket()).distinct().collect()]  # at most ``buckets`` numbers
                found = found.where(F.col(BUCKET).isin(touched))
            found = found.join(wanted, self.key, "left_semi")
        return self.merge(found.drop(BUCKET))

    def current(self) -> DataFrame:
        """One row per key as the last batch left it."""
        found = self._read(self._cover())
        empty = self.spark.createDataFrame([], self.schema)
        return self.merge((empty if found is None else found).drop(BUCKET))

    def spans(self, before: int | None = None) -> list[tuple[int, int]]:
        """First and last batch of the runs that a read takes, in order."""
        return self._cover(before)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int").alias(BUCKET)

    def _folder(self, first: int, last: int) -> str:
        return f"{self.root}/runs/{first:0{_DIGITS}d}-{last:0{_DIGITS}d}"

    def _written(self) -> list[tuple[int, int]]:
        return [(int(a), int(b)) for a, b in (name.split("-") for name in folders(self.spark, f"{self.root}/runs"))]

    def _cover(self, before: int | None = None) -> list[tuple[int, int]]:
        """The runs that no other run contains, of those that end before a batch."""
        out: list[tuple[int, int]] = []
        for first, last in sorted(self._written(), key=lambda run: (run[0], -run[1])):
            if (before is None or last < before) and (not out or last > out[-1][1]):
                out.append((first, last))
        return out

    def _read(self, cover: list[tuple[int, int]]) -> DataFrame | None:
        # folder by folder, as each has its own bucket folders
        frames = [self.spark.read.schema(self.schema).parquet(self._folder(*run)) for run in cover]
        out = None
        for frame in frames:
            out = frame if out is None else out.unionByName(frame)
        return out

    def _write(self, rows: DataFrame, first: int, last: int) -> None:
        draft = f"{self.root}/drafts/{first}-{last}"
        if self.buckets:
            rows.withColumn(BUCKET, self._bucket()).repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(draft)
        else:
            rows.hint("rebalance").write.mode("overwrite").parquet(draft)
        replace_folder(self.spark, draft, self._folder(first, last))

    def _size(self, run: tuple[int, int]) -> int:
        """How often ``fan`` goes into the number of batches of a run."""
        n, size = run[1] - run[0] + 1, 0
        while n >= self.fan:
            n, size = n // self.fan, size + 1
        return size

    def _tidy(self, batch_id: int) -> None:
        cover = self._cover(batch_id)
        for run in self._written():
            if run not in cover and run[1] < batch_id:
                delete(self.spark, self._folder(*run))
        while len(last := cover[-self.fan :]) == self.fan and len({self._size(run) for run in last}) == 1:
            joined = (last[0][0], last[-1][1])
            self._write(self.merge(self._read(last).drop(BUCKET)), *joined)
            cover = [*cover[: -self.fan], joined]
