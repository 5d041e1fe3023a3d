"""Exact top-k inner products by Fagin's threshold algorithm over sorted lists per dimension.

Vectors are dealt evenly into blocks and queries into theirs; a cell is a block of vectors with a block of queries, so each task holds at most
``block`` vectors and ``query_block`` queries. In its cell a query walks the lists of its dimensions from the end that its sign prefers,
all to the same depth, scores every vector it meets for the first time in full, and stops when the score that an unseen
vector could still reach, the sum over its dimensions at that depth, is below the k-th best. The cells' best are merged.

Depth doubles from round to round, so a query takes few rounds; what is scored beyond the stopping depth cannot hurt.

Nulls and oddities: vectors that are null or hold null or non-finite components take no part; shorter vectors count as padded with zeros;
equal scores go to the smaller id, a null id comes last; a row is never its own candidate, but another row with the same id is; fewer than k candidates
give fewer results.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stored


def scaled(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """``id, v``: usable vectors with every component as ``floor(scale * x)``."""
    v = F.col(vector_col)
    usable = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.where(usable).select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("v"))


def _matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    flat = lists.combine_chunks()
    sizes = np.diff(flat.offsets.to_numpy())
    out = np.zeros((len(flat), width), np.int64)
    out[np.repeat(np.arange(len(flat)), sizes), np.concatenate([np.arange(s) for s in sizes]) if len(sizes) else []] = flat.flatten().to_numpy()
    return out


def search(x: np.ndarray, ids: np.ndarray, query: np.ndarray, k: int, order: np.ndarray, own: int | None = None, first: int = 16) -> tuple[np.ndarray, np.ndarray, int]:
    """Ids and scores of the k best rows of ``x`` for one query, ties to the smaller id, and the depth at which it stopped.

    ``order`` holds the row numbers of each dimension's list, ascending; ``own`` is a row to leave out.
    """
    n = len(x)
    up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
    seen = np.zeros(n, bool)
    if own is not None:
        seen[own] = True
    best_ids, best = np.empty(0, np.int64), np.empty(0, np.int64)
    depth, step = 0, first
    while depth < n:
        stop = min(n, depth + step)
        if len(up) or len(down):
            met = np.concatenate([order[n - stop:n - depth, up].ravel(), order[depth:stop, down].ravel()])
        else:
            met, stop = np.arange(n), n
        new = np.unique(met)
        new = new[~seen[new]]
        seen[new] = True
        best = np.concatenate([best, x[new] @ query])
        best_ids = np.concatenate([best_ids, ids[new]])
        top = np.lexsort((best_ids, -best))[:k]
        best, best_ids, depth = best[top], best_ids[top], stop
        # No unseen row exceeds this: in every list, it lies behind the row at this depth.
        bound = query[up] @ x[order[n - stop, up], up] + query[down] @ x[order[stop - 1, down], down]
        if len(best) == k and best[-1] > bound:
            break
        step *= 2
    return best_ids, best, depth


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, block: int = 16_384, query_block: int = 1024, least: int = 256) -> DataFrame:
    """``query_id, rank, vec_id, score`` for ``vectors(row, id, v)`` and ``queries(row, id, v)``; ``row`` tells rows apart.

    Blocks hold at most about ``block`` vectors, and there are up to four for each core, of ``least`` vectors or more.
    """
    spark = vectors.sparkSession
    n, q = vectors.count(), queries.count()
    blocks = max(1, math.ceil(n / block), min(4 * spark.sparkContext.defaultParallelism, math.ceil(n / least)))
    query_blocks = max(1, math.ceil(q / query_block))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = vectors.withColumn("vb", F.pmod("row", F.lit(blocks)).cast("int")).withColumn("qb", every(query_blocks))
    right = queries.withColumn("qb", F.pmod(F.xxhash64("row"), F.lit(query_blocks)).cast("int")).withColumn("vb", every(blocks))
    schema = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def cell(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        if not len(ours) or not len(theirs):
            return schema.empty_table()
        width = max(int(np.diff(t["v"].combine_chunks().offsets.to_numpy()).max()) for t in (ours, theirs))
        x, wanted = _matrix(ours["v"], width), _matrix(theirs["v"], width)
        # Ties are decided by the place of the id among all, so that ids stay in Arrow, null or of any size.
        ids = ours["id"].combine_chunks()
        by_id = pc.array_sort_indices(ids).to_numpy()
        places = np.empty(len(ids), np.int64)
        places[by_id] = np.arange(len(ids))
        at = {row: k for k, row in enumerate(ours["row"].to_pylist())}
        order = np.argsort(x, axis=0, kind="stable")
        out = []
        for n, (row, query) in enumerate(zip(theirs["row"].to_pylist(), wanted, strict=True)):
            found, scores, _ = search(x, places, query, k, order, at.get(row))
            out.append((np.full(len(found), row), np.full(len(found), n), by_id[found], scores))
        rows, asked, vectors_found, scores = (np.concatenate(c).astype(np.int64) for c in zip(*out, strict=True))
        return pa.table([pa.array(rows), theirs["id"].combine_chunks().take(pa.array(asked)), ids.take(pa.array(vectors_found)), pa.array(scores)], schema=schema)

    found = left.groupBy("vb", "qb").cogroup(right.groupBy("vb", "qb")).applyInArrow(cell, "query_row long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def numbered(vectors: DataFrame) -> DataFrame:
    """A stored copy with a number for every row, even over blocks and the same in every reading."""
    return stored(vectors.withColumn("row", F.monotonically_increasing_id()))
