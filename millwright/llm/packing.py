"""Best-fit packing of tokenised documents into sequences, as a hierarchy of residuals.

Documents longer than a sequence are cut into full pieces; the first piece is the remainder. Every partition packs its
own pieces, longest first, each into the open bin it fits best. Bins that are nearly full are done. The underfull ones
are items of the next round: partitions of them are merged into fewer, and whole bins go into each other by the same
best fit, until one partition is left or a round saves next to nothing. Only (bin, fill) takes part in the rounds.

A round's partition holds up to ``ROUND_BINS`` bins, however many there are in all, so no task grows with the data; a round
with several partitions deals the rest anew. Tables are written after each round, so lost executors repeat one round.

Defined results: a null or empty text is the end token alone. Rows with the same or a null id are packed each by
itself. An empty table gives no pieces. Other columns of the input, whatever their names, play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.bytelevel import as_bytes, byte_level
from millwright.llm.common import arrow_type, byte_slices, field_ddl
from millwright.session import written

SIZE, END, SLACK = 2048, 0, 16  # a bin with at most SLACK free places is nearly full
LOCAL_PIECES, ROUND_BINS = 1 << 20, 1 << 18
_PIECE = "piece int, start bigint, length bigint, ids_crc32 bigint, bin bigint, offset bigint, fill bigint"


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the fill of each bin; items go longest first into the fullest bin with room."""
    n = len(sizes)
    bins, offsets, fills = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by free places
    free = 0  # a bit for each number of free places that some bin has
    for k in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[k])
        rooms = free >> size
        if rooms:
            room = size + (rooms & -rooms).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                free ^= 1 << room
        else:
            room, b = capacity, len(fills)
            fills.append(0)
        bins[k], offsets[k] = b, fills[b]
        fills[b] += size
        if room > size:
            open_bins[room - size].append(b)
            free |= 1 << (room - size)
    return bins, offsets, np.array(fills, dtype=np.int64)


def pieces(docs: DataFrame, path: str, keys: Sequence[str] = ("doc_id",), size: int = SIZE, with_ids: bool = False) -> DataFrame:
    """``keys``, piece, start, length, ids_crc32 and the place in a bin of the scan's partition (bin, offset, fill).

    ``with_ids`` adds the token ids. The vocabulary file is read on the driver and broadcast; it doesn't grow.
    """
    frame = docs.select(*keys, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    types = [arrow_type(frame, k) for k in keys]
    names = [*keys, *(c.split()[0] for c in _PIECE.split(", ")), *(["ids"] if with_ids else [])]
    with open(path, encoding="utf-8") as file:
        source = docs.sparkSession.sparkContext.broadcast(file.read())

    def packed(held: list[tuple], first_bin: int) -> tuple[Iterator[pa.RecordBatch], int]:
        rows = pa.Table.from_batches([r for r, *_ in held])
        columns = [np.concatenate(c) for c in zip(*(c for _, c, _ in held))]
        bins, offsets, fills = best_fit(columns[2], size)
        arrays = [*rows.columns, *map(pa.array, columns), pa.array(bins + first_bin), pa.array(offsets), pa.array(fills[bins])]
        if with_ids:
            tokens = np.concatenate([i for *_, i in held])
            arrays.append(pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(columns[2])]), tokens.view(np.int32)).cast(pa.list_(pa.int32())))
        return iter(pa.table(arrays, names=names).to_batches(max_chunksize=10_000)), len(fills)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_level(source.value, True)
        held, n, first_bin = [], 0, TaskContext.get().partitionId() << 36
        for batch in byte_slices(batches, "_text"):
            tokens = [as_bytes([*coder.ids(t), END]) for t in batch.column("_text").to_pylist()]
            length = np.array([len(t) // 4 for t in tokens], dtype=np.int64)
            head = (length - 1) % size + 1  # the first piece; the others are full
            count = (length - head) // size + 1
            row = np.repeat(np.arange(len(tokens)), count)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            start = np.where(piece > 0, head[row] + (piece - 1) * size, 0)
            own = np.where(piece > 0, size, head[row])
            crc = [zlib.crc32(memoryview(tokens[r])[4 * s : 4 * (s + x)]) for r, s, x in zip(row.tolist(), start.tolist(), own.tolist())]
            kept = [batch.column(k).cast(t).take(pa.array(row)) for k, t in zip(keys, types)]
            ids = np.frombuffer(b"".join(tokens), dtype=np.uint32) if with_ids else None
            held.append((pa.RecordBatch.from_arrays(kept, names=list(keys)), (piece.astype(np.int32), start, own, np.array(crc, dtype=np.int64)), ids))
            n += len(row)
            if n >= (LOCAL_PIECES // 64 if with_ids else LOCAL_PIECES):
                out, bins = packed(held, first_bin)
                yield from out
                held, n, first_bin = [], 0, first_bin + bins
        if held:
            yield from packed(held, first_bin)[0]

    return frame.mapInArrow(run, f"{field_ddl(frame, keys)}, {_PIECE}" + (", ids array<int>" if with_ids else ""))


def merged(bins: DataFrame, partitions: int, capacity: int, turn: int) -> DataFrame:
    """(bin, into, shift, fill): one round over ``bins`` (bin, fill); a merged bin keeps the id of its longest member."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches, schema=pa.schema([("bin", pa.int64()), ("fill", pa.int64())]))
        if rows.num_rows:
            own, order = rows["bin"].to_numpy(), np.argsort(rows["bin"].to_numpy())  # the same result after any retry
            own, sizes = own[order], rows["fill"].to_numpy()[order]
            into, shift, fills = best_fit(sizes, capacity)
            first = np.zeros(len(fills), dtype=np.int64)
            first[into[shift == 0]] = own[shift == 0]
            out = pa.table([own, first[into], shift, fills[into]], names=["bin", "into", "shift", "fill"])
            yield from out.to_batches(max_chunksize=10_000)

    dealt = bins.select("bin", "fill").repartition(partitions, F.xxhash64("bin", F.lit(turn)))
    return dealt.mapInArrow(run, "bin bigint, into bigint, shift bigint, fill bigint")


def rounds(bins: DataFrame, capacity: int = SIZE, slack: int = SLACK, round_bins: int = ROUND_BINS) -> DataFrame | None:
    """(bin, into, shift) over all rounds for the underfull ``bins`` (bin, fill); None where nothing can be merged."""
    moves, left, n, turn = None, bins, bins.count(), 0
    while n > 1:
        partitions = -(-n // round_bins)
        moved = written(merged(left, partitions, capacity, turn), "packing-round")
        step = moved.select(F.col("bin").alias("into"), F.col("into").alias("next"), F.col("shift").alias("more"))
        moves = moved.select("bin", "into", "shift") if moves is None else written(
            moves.join(step, "into", "left").select(
                "bin", F.coalesce("next", "into").alias("into"), (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift")
            ),
            "packing-moves",
        )
        left = moved.where(f"bin = into and fill < {capacity - slack}").select("bin", "fill")
        before, n, turn = n, left.count(), turn + 1
        if partitions == 1 or n > 0.99 * before:
            break
    return moves


def pack(docs: DataFrame, path: str, keys: Sequence[str] = ("doc_id",), size: int = SIZE, slack: int = SLACK, with_ids: bool = False) -> DataFrame:
    """``keys``, piece, start, length, ids_crc32, sequence_id, offset (and ids) per piece of every document."""
    found = written(pieces(docs, path, keys, size, with_ids), "packing-pieces")
    underfull = found.where(f"offset = 0 and fill < {size - slack}").select("bin", "fill")
    moves = rounds(underfull, size, slack)
    if moves is not None:
        found = found.join(moves, "bin", "left")
        found = found.withColumn("offset", F.col("offset") + F.coalesce("shift", F.lit(0))).withColumn("bin", F.coalesce("into", "bin"))
    ids = ["ids"] if with_ids else []
    return found.select(*keys, "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset", *ids)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of each sequence, of ``pack`` with ids; a sequence is bounded by its size."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))
