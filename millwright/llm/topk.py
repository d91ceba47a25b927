"""Exact top-k inner products by pivot-table elimination.

Distances of every vector to a fixed number of pivots are computed once. For a query q and a candidate c the
triangle inequality over each pivot p gives |d(q,p) - d(c,p)| <= d(q,c); the largest of these lower bounds over
all pivots caps the inner product, (|q|² + |c|² - d²) / 2. Candidates are evaluated in the order of their caps
until the cap falls below the k-th best score found, so the result is exact. Every query starts with the k-th
best score among the pivots, which are rows of the table themselves.

Queries and candidates are packed in blocks of bounded size, and every pair of blocks is one small task group;
each group returns at most k rows a query, and a window keeps the best k of all groups.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millwright.session import written

SCALE, EVERY, K, PIVOTS = 1024, 100, 10, 64
QUERY_BLOCK, ROW_BLOCK, STEP = 512, 8192, 256
_EXACT = 1 << 52  # sums of products below this are exact in doubles


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): one integer vector an id, floor(scale * x); rows without an id, null or non-finite parts drop out.

    Of rows that share an id the least vector counts. An empty array is a vector of no length.
    """
    component = F.col("embedding")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    whole = vectors.select("vec_id", component.cast("array<double>").alias("embedding")).where(
        "vec_id is not null and embedding is not null"
    )
    whole = whole.where(~F.exists("embedding", bad))
    floored = whole.select("vec_id", F.transform("embedding", lambda x: F.floor(x * scale).cast("bigint")).alias("v"))
    return floored.groupBy("vec_id").agg(F.min("v").alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of equal width as a matrix; shorter vectors end in zeros, which leave products as they are."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _scores(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, exact: in doubles where these are exact, else in Python's integers, held to 64 bits."""
    top = float(np.abs(rows).max(initial=0)) * float(np.abs(query).max(initial=0)) * max(1, rows.shape[1])
    if top < _EXACT:
        return (rows.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    limit = (1 << 63) - 1
    return np.array([max(-limit, min(limit, int(x))) for x in rows.astype(object) @ query.astype(object)], dtype=np.int64)


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    rows, pivots = rows.astype(np.float64), pivots.astype(np.float64)
    square = (rows**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * rows @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def search_block(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, pivot_ids: np.ndarray, pivots: np.ndarray, k: int
) -> list[tuple[int, int, int]]:
    """(query id, row id, score) of up to ``k`` rows for each query, none of those that the best ``k`` of all need left out."""
    by_pivot, to_pivot = _distances(rows, pivots), _distances(queries, pivots)
    norm, query_norm = (rows.astype(np.float64) ** 2).sum(1), (queries.astype(np.float64) ** 2).sum(1)
    out = []
    for q, (own, query) in enumerate(zip(query_ids.tolist(), queries)):
        known = np.sort(_scores(pivots[pivot_ids != own], query))
        floor = known[-k] if len(known) >= k else None
        bound = np.abs(by_pivot - to_pivot[q]).max(1) if len(pivots) else np.zeros(len(rows))
        # rounding of distances stays far below this slack
        slack = 1e-9 * (norm + query_norm[q]) + 1
        gap = np.maximum(0, bound * (1 - 1e-9) - 1e-6 * np.sqrt(norm + query_norm[q]))
        cap = (norm + query_norm[q] - gap**2) / 2 + slack
        cap[ids == own] = -np.inf
        order = np.flatnonzero(cap >= (floor if floor is not None else -np.inf))
        order = order[ids[order] != own]
        order = order[np.argsort(-cap[order], kind="stable")]
        best_ids, best = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for at in range(0, len(order), STEP):
            part = order[at : at + STEP]
            if floor is not None and cap[part[0]] < floor:
                break
            best_ids, best = np.concatenate([best_ids, ids[part]]), np.concatenate([best, _scores(rows[part], query)])
            kept = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[kept], best[kept]
            if len(best) == k:
                floor = best[-1] if floor is None else max(floor, best[-1])
        out += [(own, i, s) for i, s in zip(best_ids.tolist(), best.tolist())]
    return out


def top_k(
    vectors: DataFrame,
    k: int = K,
    every: int = EVERY,
    n_pivots: int = PIVOTS,
    query_block: int = QUERY_BLOCK,
    row_block: int = ROW_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest inner products of each row whose id ``every`` divides.

    Candidates are all rows of :func:`integer_vectors` but the query's own; ties go to the smaller id. A query with
    fewer candidates gets all of them. Vectors of unequal length are compared as if zeros followed the shorter one.
    """
    rows = written(integer_vectors(vectors), "vectors")
    n, width, n_queries = rows.agg(F.count("*"), F.max(F.size("v")), F.count_if(F.col("vec_id") % every == 0)).first()
    width = width or 0
    # the pivots: a fixed number of rows spread by hash
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n_pivots).collect()
    pivot_ids = np.array([r[0] for r in chosen], dtype=np.int64)
    pivots = np.zeros((len(chosen), width), dtype=np.int64)
    for i, r in enumerate(chosen):
        pivots[i, : len(r[1])] = r[1]

    n_row_blocks, n_query_blocks = max(1, -(-n // row_block)), max(1, -(-n_queries // query_block))
    own = F.pmod(F.xxhash64("vec_id"), F.lit(n_row_blocks))
    asked = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(n_query_blocks))
    all_ = lambda m: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(m - 1).cast("bigint")))
    candidates = rows.select(own.alias("c"), F.lit(False).alias("asks"), "vec_id", "v").withColumn("q", all_(n_query_blocks))
    queries = (
        rows.where(F.col("vec_id") % every == 0)
        .select(asked.alias("q"), F.lit(True).alias("asks"), "vec_id", "v")
        .withColumn("c", all_(n_row_blocks))
    )
    both = candidates.unionByName(queries).repartition("q", "c").sortWithinPartitions("q", "c")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by block pair; a pair may run over several batches."""
        held: list[pa.Table] = []

        def answer(pair: pa.Table) -> pa.RecordBatch:
            pair = pair.combine_chunks()
            asks = pair.column("asks").to_numpy()
            ids = pair.column("vec_id").to_numpy()
            matrix = _matrix(pair.column("v").chunk(0), width)
            found = search_block(ids[asks], matrix[asks], ids[~asks], matrix[~asks], pivot_ids, pivots, k) if asks.any() else []
            columns = list(zip(*found)) if found else [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            pair = batch.column("q").to_numpy() * n_row_blocks + batch.column("c").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(pair)) + 1).tolist(), len(pair)]
            for a, b in zip(cuts, cuts[1:]):
                if last is not None and pair[a] != last:
                    yield answer(pa.concat_tables(held))
                    held = []
                last = pair[a]
                held.append(pa.Table.from_batches([batch.slice(a, b - a)]))
        if held:
            yield answer(pa.concat_tables(held))

    found = both.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
