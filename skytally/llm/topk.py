"""Exact top-k by inner product of whole numbers, without random access.

Each block of vectors holds one list per dimension, sorted by component. A query reads the
lists from the end that helps it (from the top where its own component is positive, from the
bottom where it is negative), all to the same depth. What has been read of a vector, and the
last values read, give a lower and an upper bound of its score. Reading goes on until few
vectors can still be among the best; their scores are then resolved. All queries of a slice
read the same lists, so their bounds come from matrix products.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.llm.vectors import best, matrix, ranked, usable

_BLOCK = 4096
_SLICE = 1024
_EXACT = 2.0**53
_LONG = 2**63 - 1


class SortedLists:
    """A block's vectors with the rank of each in every dimension's list."""

    def __init__(self, points: np.ndarray):
        self.points = points
        n, size = points.shape
        order = np.argsort(-points, axis=0, kind="stable")
        self.sorted = np.take_along_axis(points, order, axis=0)
        self.rank = np.empty((n, size), np.int32)
        np.put_along_axis(self.rank, order, np.arange(n, dtype=np.int32)[:, None], axis=0)

    def bounds(self, queries: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds (queries, vectors) after reading ``depth`` of each list."""
        n = len(self.points)
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        from_top, from_bottom = self.rank < depth, self.rank >= n - depth

        def total(unread_top, unread_bottom):
            top = np.where(from_top, self.points, unread_top)
            bottom = np.where(from_bottom, self.points, unread_bottom)
            return up @ top.T + down @ bottom.T

        lower = total(self.sorted[-1], self.sorted[0])
        return lower, total(self.sorted[depth - 1], self.sorted[n - depth])


def top_of_block(points, ids, queries, query_ids, k: int, few=64):
    """(query, vector, score) of each query's k best in the block, its own id left out."""
    lists, n = SortedLists(points), len(points)
    open_ = np.arange(len(queries))
    found, depth = [], max(1, n // 4)
    while len(open_):
        depth = min(depth, n)
        lower, upper = lists.bounds(queries[open_], depth)
        own = query_ids[open_][:, None] == ids
        lower[own], upper[own] = -np.inf, -np.inf
        keep = min(k, n)
        least = np.partition(lower, n - keep, axis=1)[:, n - keep]
        can = (upper >= least[:, None]) & ~own
        still = []
        for row, number in enumerate(open_):
            places = np.flatnonzero(can[row])
            if len(places) > max(few, 2 * k) and depth < n:
                still.append(number)
                continue
            scores = points[places] @ queries[number]
            top = best(scores, ids[places], k)
            found.append((np.full(len(top), query_ids[number]), ids[places][top], scores[top]))
        open_, depth = np.array(still, np.int64), depth + max(1, n // 4)
    return [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0)] * 3


def _with_long_numbers(points, ids, queries, query_ids, k: int):
    """The same for numbers too large for doubles, one by one."""
    rows = [[int(x) for x in row] for row in points]
    found = []
    for query, own in zip(queries, query_ids):
        query = [int(x) for x in query]
        scores = [
            (-sum(a * b for a, b in zip(row, query)), i) for row, i in zip(rows, ids) if i != own
        ]
        found += [(own, i, max(min(-s, _LONG), -_LONG)) for s, i in sorted(scores)[:k]]
    return [np.array(c, np.int64) for c in zip(*found)] if found else [np.zeros(0)] * 3


def search(
    vectors: DataFrame, is_query: Column, k=5, scale=256, key="vec_id", vector="embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` highest scores for each query, exactly.

    A component x counts as floor(``scale`` * x). Queries are the rows of which ``is_query``
    holds; candidates are all other ids; ties go to the smaller id. Scores beyond a long are
    cut to it. Which rows take part: see :func:`skytally.llm.vectors.usable`. Empty tables
    give no rows.
    """
    rows = usable(vectors, key, vector, zeros=True)
    asked = rows.select(F.col("id").alias(key), "vector").where(is_query)
    asked = asked.select(F.col(key).alias("id"), "vector")
    blocks, slices = max(1, -(-rows.count() // _BLOCK)), max(1, -(-asked.count() // _SLICE))

    def cell(name, n):
        return F.pmod(F.xxhash64("id", F.lit(name)), F.lit(n)).cast("int").alias(name)

    def each(name, n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)

    entries = rows.select("*", cell("block", blocks), each("slice", slices))
    asked = asked.select("*", cell("slice", slices), each("block", blocks))

    def run(queries: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        columns = [np.zeros(0)] * 3
        if len(queries) and len(entries):
            points = np.floor(scale * matrix(entries["vector"]))
            asked = np.floor(scale * matrix(queries["vector"]))
            reach = np.abs(points).max() * np.abs(asked).max() * points.shape[1]
            work = top_of_block if reach < _EXACT else _with_long_numbers
            columns = work(points, entries["id"].to_numpy(), asked, queries["id"].to_numpy(), k)
        names = ("query_id", "vec_id", "score")
        return pd.DataFrame({n: c.astype(np.int64) for n, c in zip(names, columns)})

    by = ["block", "slice"]
    found = asked.groupBy(*by).cogroup(entries.groupBy(*by)).applyInPandas(
        run, "query_id long, vec_id long, score long"
    )
    return ranked(found, k)
