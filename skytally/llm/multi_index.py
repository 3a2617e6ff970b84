"""Approximate nearest neighbours by an inverted multi-index.

The two halves of a vector are quantised apart; a cell is a pair of centroids. A query goes
through the cells by the sum of its distances to their two centroids, nearest first, by a heap
over the two sorted lists of distances, until the cells visited hold enough vectors. All
entries of these cells are ranked again by the inner product with the original vectors.
"""

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.llm.common import staged
from skytally.llm.vectors import best, exact_scores, matrix, ranked, usable

_BLOCK = 8192
_SLICE = 4096
_QUERIES_AT_ONCE = 256


def _centroids(points: np.ndarray, count: int, rounds=12) -> np.ndarray:
    """k-means from a fixed start."""
    start = np.random.default_rng(0).permutation(len(points))[:count]
    centroids = points[np.sort(start)].copy()
    for _ in range(rounds):
        nearest = _distances(points, centroids).argmin(axis=1)
        for number in range(len(centroids)):
            own = points[nearest == number]
            if len(own):
                centroids[number] = own.mean(axis=0)
    return centroids


def _distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, but for a term that depends on the point only."""
    return (centroids**2).sum(axis=1) - 2 * points @ centroids.T


def visited_cells(first: np.ndarray, second: np.ndarray, counts: np.ndarray, enough: int) -> np.ndarray:
    """Cells in the order of summed distance, until they hold ``enough`` vectors.

    ``first`` and ``second``: distances to the centroids of the halves. ``counts``: vectors in
    each cell. Empty cells are passed over.
    """
    order_a, order_b = first.argsort(kind="stable"), second.argsort(kind="stable")
    a, b = first[order_a].tolist(), second[order_b].tolist()
    width, taken, out = len(b), 0, []
    sizes = counts.reshape(len(a), width)[order_a][:, order_b].tolist()
    # Row i of the grid enters when row i - 1 has given its first cell.
    heap = [(a[0] + b[0], 0, 0)]
    while heap and taken < enough:
        _, i, j = heap[0]
        if j + 1 < width:
            heapq.heapreplace(heap, (a[i] + b[j + 1], i, j + 1))
        else:
            heapq.heappop(heap)
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
        if sizes[i][j]:
            taken += sizes[i][j]
            out.append((i, j))
    places = np.array(out, np.int64).reshape(-1, 2)
    return order_a[places[:, 0]] * width + order_b[places[:, 1]]


def search(
    vectors: DataFrame,
    is_query: Column,
    k=20,
    centroids=64,
    visit=0.5,
    sample=20_000,
    key="vec_id",
    vector="embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest found for each query.

    Queries are the rows of which ``is_query`` holds; candidates are all other ids. Nearness is
    the largest inner product in double precision, ties go to the smaller id. ``visit`` is the
    share of all vectors whose cells are visited (no fewer than 64 * k vectors): with nearly
    unstructured vectors a small share misses too many. ``sample`` bounds the vectors the
    centroids are fitted to; every vector is indexed. Which rows take part: see
    :func:`skytally.llm.vectors.usable`, zero vectors do not. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector, zeros=False)
    total = rows.count()
    some = rows.orderBy(F.xxhash64("id"), "id").limit(sample).toPandas()
    size = len(some["vector"].iloc[0]) if len(some) else 1
    points = matrix(some["vector"]) if len(some) else np.zeros((1, 1))
    half = size // 2
    count = max(1, min(centroids, len(some) // 16))
    books = _centroids(points[:, :half], count), _centroids(points[:, half:], count)

    def halves(points):
        return _distances(points[:, :half], books[0]), _distances(points[:, half:], books[1])

    def placed(batches):
        for batch in batches:
            flat = batch.column("vector").flatten().to_numpy().reshape(-1, size)
            a, b = halves(flat)
            cells = a.argmin(axis=1) * count + b.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells.astype(np.int32))], ["id", "vector", "cell"]
            )

    index = staged(rows.mapInArrow(placed, "id long, vector array<double>, cell int"), "index")
    counts = np.zeros(count * count, np.int64)
    for cell, n in index.groupBy("cell").count().collect():
        counts[cell] = n
    # Neighbouring cells share a block of bounded size; a large cell has several.
    parts = -(-counts // _BLOCK)
    block_of = np.cumsum(np.where(parts > 1, 0, counts)) // _BLOCK
    block_of = np.where(parts > 1, counts.size + np.arange(counts.size), block_of)
    shared, enough = spark.sparkContext.broadcast((counts, parts, block_of)), max(visit * total, 64 * k)
    slices = max(1, -(-total // _SLICE // 16))

    def dealt(batches):
        """Entries with their block and part."""
        _, parts, block_of = shared.value
        for batch in batches:
            cells, ids = batch.column("cell").to_numpy(), batch.column("id").to_numpy()
            mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
            part = mixed % np.maximum(parts[cells], 1).astype(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(block_of[cells].astype(np.int32)), pa.array(part.astype(np.int32))],
                ["id", "vector", "cell", "block", "part"],
            )

    def probes(batches):
        """One row for each block part a query visits, with the cells visited in it."""
        counts, parts, block_of = shared.value
        for batch in batches:
            flat = batch.column("vector").flatten().to_numpy().reshape(-1, size)
            out = {n: [] for n in ("id", "vector", "block", "part", "cells")}
            for number, (a, b) in enumerate(zip(*halves(flat))):
                cells = visited_cells(a, b, counts, enough)
                for block in np.unique(block_of[cells]):
                    own = cells[block_of[cells] == block]
                    for part in range(int(parts[own].max())):
                        out["id"].append(batch.column("id")[number].as_py())
                        out["vector"].append(flat[number])
                        out["block"].append(int(block))
                        out["part"].append(part)
                        out["cells"].append(own.astype(np.int32))
            yield pa.RecordBatch.from_pydict(
                out,
                pa.schema(
                    [("id", pa.int64()), ("vector", pa.list_(pa.float64())), ("block", pa.int32())]
                    + [("part", pa.int32()), ("cells", pa.list_(pa.int32()))]
                ),
            )

    entry = "id long, vector array<double>, cell int, block int, part int"
    probe = "id long, vector array<double>, block int, part int, cells array<int>"
    slice_ = F.pmod(F.xxhash64("id"), F.lit(slices)).cast("int").alias("slice")
    entries = index.mapInArrow(dealt, entry).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice")
    )
    asked = index.select(quoted_id(key), "vector").where(is_query)
    asked = asked.select(F.col(key).alias("id"), "vector")
    # The queries, however few files they lie in, are a search each. With a number, or small
    # partitions would be made one again.
    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = asked.repartition(tasks, F.col("id")).mapInArrow(probes, probe).select("*", slice_)

    def nearest(probes: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(probes) and len(entries):
            points, ids = matrix(entries["vector"]), entries["id"].to_numpy()
            cells, cell_of = np.unique(entries["cell"].to_numpy(), return_inverse=True)
            for at in range(0, len(probes), _QUERIES_AT_ONCE):
                some = probes.iloc[at : at + _QUERIES_AT_ONCE]
                queries = matrix(some["vector"])
                scores = queries @ points.T
                for row, (query, visited, own) in enumerate(zip(queries, some["cells"], some["id"])):
                    ok = np.isin(cells, visited)[cell_of] & (ids != own)
                    places = np.flatnonzero(ok)
                    near = scores[row, places]
                    if len(near) > k:
                        least = np.partition(near, len(near) - k)[len(near) - k]
                        slack = 1e-9 * max(1.0, np.abs(near).max())
                        places = places[near >= least - slack]
                    exact = exact_scores(points[places], query)
                    top = best(exact, ids[places], k)
                    found.append((np.full(len(top), own), ids[places][top], exact[top]))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0)] * 3
        return pd.DataFrame(
            {
                "query_id": columns[0].astype(np.int64),
                "vec_id": columns[1].astype(np.int64),
                "score": columns[2].astype(float),
            }
        )

    by = ["block", "part", "slice"]
    found = asked.groupBy(*by).cogroup(entries.groupBy(*by)).applyInPandas(
        nearest, "query_id long, vec_id long, score double"
    )
    return ranked(found, k)


def quoted_id(key: str) -> Column:
    """The id under the name ``is_query`` knows it by."""
    return F.col("id").alias(key)
