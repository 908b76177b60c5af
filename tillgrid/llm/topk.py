"""Exact top-k inner products by Fagin's threshold algorithm.

Vectors become integers, floor(256 * x). Candidates are dealt into blocks of a
bounded number of rows; a block holds, for each dimension, its rows sorted by
that component. For a query the lists are read from the end where the query's
component makes the products largest, some ranks at a time; each row that
appears is scored in full. The products at the ranks reached add up to a bound
on every row not seen yet. A block is done for a query when the bound is below
its k-th score (at a tie it goes on, as smaller ids win). The best of all
blocks, k per block at most, are merged by a window.

Rows that are null or hold null or non-finite components, or have a null id,
take no part; neither do candidates of another length than the query. Products
are exact whatever the size of the components; a score that no long can hold
counts as the largest or smallest long. Rows that repeat an id are candidates
each, of equal rank up to their score, and are dealt over all blocks; a row is
no candidate of a query with its own id. An empty vector's products are 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K, SCALE, EVERY = 5, 256, 50
BLOCK_ROWS, QUERY_ROWS = 4096, 1024
FIRST_RANKS = 16
# Doubles of this size are whole numbers when scaled; integers below the second are exact as doubles, sums included.
WHOLE, EXACT = 2.0**44, 2**52
LEAST_LONG, LARGEST_LONG = -(1 << 63), (1 << 63) - 1


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, v (array of double): the rows that take part, each component floor(256 * x) / 256, which a double holds exactly."""
    x = F.col("embedding").cast("array<double>")
    usable = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    )
    whole = lambda c: F.when(F.abs(c) >= WHOLE, c).otherwise(F.floor(F.when(F.abs(c) < WHOLE, c) * SCALE) / F.lit(float(SCALE)))
    return embeddings.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, whole).alias("v"))


def scaled(v: np.ndarray) -> np.ndarray:
    """The integers 256 * v: of 64 bits if all are small, else Python's."""
    if not v.size or np.abs(v).max() < WHOLE:
        return (v * SCALE).astype(np.int64)
    return np.array([int(c * SCALE) if abs(c) < WHOLE else int(c) * SCALE for c in v.ravel().tolist()], object).reshape(v.shape)


def largest(v: np.ndarray) -> int:
    return max(map(abs, (int(v.max()), int(v.min())))) if v.size else 0


class Block:
    """Sorted lists of one block's vectors and the threshold algorithm over them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.exact = ids[order], vectors[order]
        # float products of small integers are exact; beyond them Python's integers are used
        self.most = max(1, vectors.shape[1]) * largest(self.exact)
        self.plain = self.most < EXACT
        self.vectors = self.exact.astype(np.float64) if self.plain else self.exact.astype(object)
        self.lists = np.argsort(self.exact, axis=0, kind="stable")  # per dimension, ascending
        self.values = np.take_along_axis(self.vectors, self.lists, axis=0)

    def best(self, own_id: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(id, score) of the k best, by falling score, then id."""
        n = len(self.ids)
        q = query.astype(np.float64) if self.most * largest(query) < EXACT else query.astype(object)
        vectors, values = self.vectors, self.values
        if q.dtype == object and self.plain:
            vectors, values = self.exact.astype(object), np.take_along_axis(self.exact, self.lists, axis=0).astype(object)
        used = np.flatnonzero(query)
        falling = query[used] > 0
        unseen = self.ids != own_id
        at, top = np.empty(0, np.int64), np.empty(0, q.dtype)
        done, step = 0, FIRST_RANKS
        if not len(used):
            done = n
            at = np.flatnonzero(unseen)[:k]
            top = np.zeros(len(at), q.dtype)
        while done < n:
            upto = min(n, done + step)
            rows = np.concatenate([
                self.lists[n - upto : n - done][:, used[falling]].ravel(), self.lists[done:upto][:, used[~falling]].ravel()
            ])
            new = np.zeros(n, bool)
            new[rows] = True
            new &= unseen
            unseen &= ~new
            fresh = np.flatnonzero(new)
            at = np.concatenate([at, fresh])
            top = np.concatenate([top, held(vectors[fresh] @ q)])
            if len(at) > k:
                keep = np.lexsort((at, -top))[:k] if q.dtype != object else sorted(range(len(at)), key=lambda i: (-top[i], at[i]))[:k]
                at, top = at[keep], top[keep]
            done, step = upto, step * 2
            if len(at) == k and done < n:
                ends = np.where(falling, values[n - done, used], values[done - 1, used])
                if min((ends * q[used]).sum(), LARGEST_LONG) < top[-1]:
                    break
        return [(int(self.ids[i]), int(s)) for i, s in zip(at, top)]


def held(scores: np.ndarray) -> np.ndarray:
    """Scores as a long can hold them."""
    if scores.dtype != object:
        return scores
    return np.array([min(max(s, LEAST_LONG), LARGEST_LONG) for s in scores.tolist()], object)


def top_k(embeddings: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank (from 1), vec_id, score.

    ``queries`` is a filter of rows of the same shape. Blocks of candidates and
    blocks of queries form a grid; the smaller side is repeated, and no cell of
    the grid is larger than its two bounds.
    """
    # Rows are dealt by their place in the table too, so that no block is large because rows repeat.
    rows, asked = (whole_vectors(x).withColumn("row", F.monotonically_increasing_id()) for x in (embeddings, queries))
    n, q = rows.count(), asked.count()
    blocks, parts = max(1, -(-n // BLOCK_ROWS)), max(1, -(-q // QUERY_ROWS))
    cell = lambda own, count, others: (
        F.pmod(F.xxhash64("vec_id", "v", "row"), F.lit(count)).cast("int").alias(own), F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias("part" if own == "block" else "block")
    )
    candidates = rows.select("vec_id", "v", *cell("block", blocks, parts))
    asking = asked.select("vec_id", "v", *cell("part", parts, blocks))

    def run(asking: pa.Table, candidates: pa.Table) -> pa.Table:
        out: list[tuple] = []
        for length, ids, vectors in by_length(candidates):
            block = Block(ids, vectors)
            for own_length, own_ids, own_vectors in by_length(asking):
                if own_length == length:
                    for own, vector in zip(own_ids, own_vectors):
                        out += [(int(own), vec, score) for vec, score in block.best(own, vector, k)]
        return pa.Table.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(3)], names=["query_id", "vec_id", "score"])

    found = (
        asking.groupBy("block", "part").cogroup(candidates.groupBy("block", "part"))
        .applyInArrow(run, "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def by_length(rows: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    lists = rows.column("v").combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], pa.list_(pa.float64()))
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    ids, flat = rows.column("vec_id").to_numpy(), lists.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        yield int(length), ids[at], scaled(flat[starts[at][:, None] + np.arange(length)].reshape(len(at), int(length)))
