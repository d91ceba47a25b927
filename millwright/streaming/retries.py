"""Documents whose work fails: tried again with later batches, then put aside.

One bad document must not hold up the others of its batch. When the work on a batch fails, the batch is halved by a hash
of the document, and the halves are tried by themselves, until the documents that fail alone are known. They wait below
``<root>/waiting``, with the number of their attempts, and are tried again with each following batch. After ``tries``
attempts a document goes to ``<root>/dead`` with its last error.

The work must be such that a document can be given to it again (``plans/ledger.py`` is). Both tables are
written per batch, and a batch reads what the batch before it left, so counts survive restarts and repeats.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .sinks import write_batch

Work = Callable[[DataFrame], None]

ATTEMPTS, REASON = "attempts", "reason"
_HASH_BITS = 64
_LONGEST_REASON = 2000


class TooManyFailures(RuntimeError):
    """So many documents fail that something else must be wrong; nothing is put aside, and the batch can be run again."""


def failures(docs: DataFrame, work: Work, key: str, most: int) -> dict[str, str]:
    """The documents on which ``work`` fails by itself, with their errors; the work of all others is done.

    Every failing document costs a run of ``work`` per halving. At more than ``most`` the search ends with an error.
    """
    found: dict[str, str] = {}

    def attempt(part: DataFrame, bit: int) -> None:
        try:
            work(part)
            return
        except Exception as error:
            names = [r[0] for r in part.select(key).distinct().limit(2).collect()]
            if not names:
                raise  # not the fault of a document
            if len(names) == 1 or bit == _HASH_BITS:
                # documents of one hash can't be told apart by it: they wait together
                more = names if len(names) == 1 else [r[0] for r in part.select(key).distinct().limit(most + 1).collect()]
                found.update(dict.fromkeys(more, str(error)[:_LONGEST_REASON]))
                if len(found) > most:
                    raise TooManyFailures(f"more than {most} documents fail, the last with: {error}") from error
                return
        side = F.shiftrightunsigned(F.xxhash64(key), bit).bitwiseAND(F.lit(1))
        attempt(part.where(side == 0), bit + 1)
        attempt(part.where(side == 1), bit + 1)

    attempt(docs, 0)
    return found


def retrying(work: Work, root: str, key: str = "doc_id", tries: int = 3, most: int = 100) -> Callable[[DataFrame, int], None]:
    """A function for ``foreachBatch`` that does ``work`` on a batch of documents and on those that wait.

    A batch holds one row per document; the key is a text and not null. A newer version of a document takes the
    place of one that waits, and its attempts begin anew.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        due = batch.withColumn(ATTEMPTS, F.lit(0))
        if batch_id:
            schema = StructType([*batch.schema.fields]).add(ATTEMPTS, "integer").add(REASON, "string")
            waiting = batch.sparkSession.read.schema(schema).parquet(f"{root}/waiting/batch_id={batch_id - 1}")
            due = due.unionByName(waiting.drop(REASON).join(batch.select(key), key, "left_anti"))
        due = due.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            found = failures(due.drop(ATTEMPTS), work, key, most)
            reasons = batch.sparkSession.createDataFrame(list(found.items()), f"{key} string, {REASON} string")  # ``most`` rows
            failed = due.join(F.broadcast(reasons), key).withColumn(ATTEMPTS, F.col(ATTEMPTS) + 1)
            write_batch(failed.where(F.col(ATTEMPTS) >= tries), f"{root}/dead", batch_id)
            write_batch(failed.where(F.col(ATTEMPTS) < tries), f"{root}/waiting", batch_id)
        finally:
            due.unpersist()

    return step
