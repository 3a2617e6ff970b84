"""Vector tables for the searches."""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.llm.common import quoted, staged, whole_number


def usable(frame: DataFrame, key: str, vector: str, zeros: bool) -> DataFrame:
    """(id, vector of doubles) of the rows that take part in a search.

    Left out: null ids, and vectors that are null, empty, or hold null or non-finite
    components; without ``zeros`` also zero vectors. An id that repeats stands for one vector,
    the least of its own. Vectors must have one length; if they have several, the commonest
    length takes part (the smaller one on a tie).
    """
    rows = frame.select(
        whole_number(quoted(key)).alias("id"),
        quoted(vector).cast("array<double>").alias("vector"),
    )

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    good = F.coalesce(F.forall("vector", finite), F.lit(False)) & (F.size("vector") > 0)
    if not zeros:
        good &= F.exists("vector", lambda x: x != 0)
    rows = rows.where(F.col("id").isNotNull() & good)
    rows = staged(rows.groupBy("id").agg(F.min("vector").alias("vector")), "vectors")
    sizes = rows.groupBy(F.size("vector").alias("size")).count()
    common = sizes.orderBy(F.desc("count"), "size").first()
    return rows.where(F.size("vector") == (common["size"] if common else 0))


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy())


def exact_scores(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, summed for each row in the same way wherever it stands."""
    return np.ascontiguousarray(rows * query).sum(axis=1)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, highest first, ties to smaller ids."""
    return np.lexsort((ids, -scores))[:k]


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query's (query_id, vec_id, score) rows, with their rank from 1.

    The rows of a query are few: k from each block of vectors.
    """
    top = F.slice(
        F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("order"), "vec_id", "score"))), 1, k
    )
    rows = found.groupBy("query_id").agg(top.alias("top"))
    rows = rows.select("query_id", F.posexplode("top"))
    return rows.select(
        "query_id", (F.col("pos") + 1).alias("rank"), F.col("col.vec_id"), F.col("col.score")
    )
