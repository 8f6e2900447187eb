"""Exact top-k search over vectors with an impact-ordered, score-at-a-time index.

Components are turned into integers. A block of candidates is indexed by dimension: its rows are
sorted by component and cut into segments of equal quantised component. For a query, a segment's
impact is what it can add at most to a score above the least its dimension adds. Segments of all
dimensions are taken together by descending impact; each adds one amount to the accumulators of
its rows. At any time an accumulator is a lower bound, and lower bound plus slack an upper bound,
where the slack holds the quantisation error of taken segments and the most that segments not
taken can add. The scan stops only when the rows whose upper bound reaches the k-th lower bound
are few enough to score exactly, or when all segments are taken; nothing is left out on a guess.

Queries and candidates are dealt into blocks of bounded size, and each pair of blocks is one group
of a cogroup: memory depends on the block sizes alone, and a hot key cannot exist.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCHEMA = "query_id long, vec_id long, score long"


def integer_vector(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, in double; null if any component is null or not finite."""
    x = F.transform(vector, lambda v: v.cast("double"))
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    whole = F.transform(x, lambda v: F.floor(v * F.lit(float(scale))).cast("long"))
    return F.when((F.size(x) > 0) & ~F.exists(x, bad), whole)


class ImpactIndex:
    """Segments of one block of integer vectors, by dimension."""

    def __init__(self, vectors: np.ndarray, levels: int):
        self.vectors = vectors.astype(np.float64)
        rows, lows, highs, ends, dims = [], [], [], [], []
        at = 0
        for d in range(vectors.shape[1]):
            x = vectors[:, d]
            order = np.argsort(x, kind="stable")
            low = x[order[0]]
            width = max(1, -(-(int(x[order[-1]]) - int(low) + 1) // levels))
            level = (x[order] - low) // width
            cut = np.flatnonzero(np.diff(level)) + 1
            starts, stops = np.r_[0, cut], np.r_[cut, len(order)]
            rows.append(order.astype(np.int32))
            lows.append(x[order[starts]])
            highs.append(x[order[stops - 1]])
            ends.append(np.stack([starts, stops], 1) + at)
            dims.append(np.full(len(starts), d))
            at += len(order)
        self.rows = np.concatenate(rows)
        self.low, self.high = np.concatenate(lows).astype(float), np.concatenate(highs).astype(float)
        self.start, self.stop = np.concatenate(ends).T
        self.dim = np.concatenate(dims)
        self.first = np.flatnonzero(np.r_[True, np.diff(self.dim) > 0])

    def search(self, query: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
        """Rows that can be among the k best; proven to hold all of them, ties included."""
        n, n_dims = self.vectors.shape
        if n <= 4 * k:
            return np.arange(n)
        weight = query[self.dim].astype(float)
        low, high = np.minimum(weight * self.low, weight * self.high), np.maximum(weight * self.low, weight * self.high)
        floor = np.minimum.reduceat(low, self.first)
        impact = high - floor[self.dim]
        order = np.argsort(-impact, kind="stable")
        ahead, error = impact[order], (high - low)[order]
        sizes = (self.stop - self.start)[order]
        bounds = np.searchsorted(np.cumsum(sizes), np.linspace(0, sizes.sum(), rounds + 1)[1:], side="left") + 1
        bounds[-1] = len(order)
        score, taken = np.full(n, floor.sum()), 0
        seen_error = np.zeros(n_dims)
        possible = np.arange(n)
        for stop in bounds:
            if stop <= taken:
                continue
            part = order[taken:stop]
            size = sizes[taken:stop]
            at = np.arange(size.sum()) + np.repeat(self.start[part] - np.r_[0, np.cumsum(size)[:-1]], size)
            gain = low[part] - floor[self.dim[part]]
            score += np.bincount(self.rows[at], weights=np.repeat(gain, size), minlength=n)
            np.maximum.at(seen_error, self.dim[part], error[taken:stop])
            taken = stop
            left = np.zeros(n_dims)
            np.maximum.at(left, self.dim[order[taken:]], ahead[taken:])
            slack = np.maximum(seen_error, left).sum()
            least = np.partition(score, n - k)[n - k]
            possible = np.flatnonzero(score + slack >= least)
            if len(possible) <= max(4 * k, n // 8):
                break
        return possible


def _matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]).reshape(n, -1)


def _search_cell(k: int, levels: int):
    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out = [[], [], []]
        if queries.num_rows and candidates.num_rows:
            index = ImpactIndex(_matrix(candidates["vector"], candidates.num_rows), levels)
            ids = candidates["id"].to_numpy()
            for qid, query in zip(queries["id"].to_numpy(), _matrix(queries["vector"], queries.num_rows)):
                own = int((ids == qid).sum())
                rows = index.search(query, k + own)
                rows = rows[ids[rows] != qid]
                score = (index.vectors[rows] @ query.astype(float)).astype(np.int64)
                best = np.lexsort((ids[rows], -score))[:k]
                out[0] += [qid] * len(best)
                out[1] += ids[rows][best].tolist()
                out[2] += score[best].tolist()
        return pa.table([pa.array(x, pa.int64()) for x in out], names=["query_id", "vec_id", "score"])

    return run


def top_k(
    queries: DataFrame,
    candidates: DataFrame,
    k: int = 5,
    levels: int = 32,
    query_block: int = 2048,
    candidate_block: int = 16384,
) -> DataFrame:
    """The ``k`` candidates with the highest inner product for each query.

    Both frames hold ``id long`` and ``vector array<long>``; other columns are ignored. Returns
    ``query_id, rank, vec_id, score``, ties to the smaller id, fewer rows where there are fewer
    candidates. A candidate with the query's id is left out. Null ids and null vectors take no
    part, repeated rows count once, only vectors of equal length are compared, and empty inputs
    give no rows. Products are summed in double: exact while a score stays below 2**53.
    """
    sides = []
    for df, rows in ((queries, query_block), (candidates, candidate_block)):
        df = df.select("id", "vector").dropna().filter(F.size("vector") > 0).distinct()
        blocks = max(1, -(-df.count() // rows))
        sides.append((df.withColumn("n", F.size("vector")), blocks))
    (q, n_q), (c, n_c) = sides
    block = lambda n: F.pmod(F.xxhash64("id", "vector"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = q.withColumn("qb", block(n_q)).withColumn("cb", every(n_c))
    c = c.withColumn("cb", block(n_c)).withColumn("qb", every(n_q))
    keys = ["n", "qb", "cb"]
    found = q.groupBy(*keys).cogroup(c.groupBy(*keys)).applyInArrow(_search_cell(k, levels), SCHEMA)
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
