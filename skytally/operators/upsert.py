"""Keyed writes as joins: insert-or-replace, and changing single fields."""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_one(rows: DataFrame, keys, order) -> DataFrame:
    """One row per key, the first by ``order``.

    Spark limits each group before the shuffle as well (WindowGroupLimit), so copies of
    one key leave a task as a single row.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def without_keys(rows: DataFrame, others: DataFrame, keys) -> DataFrame:
    """The rows whose keys are not among those of ``others``. Null is a value like any other."""
    known = others.select(*[F.col(k).alias(f"_other_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_other_{k}")) for k in keys]
    return rows.join(known, reduce(lambda a, b: a & b, same), "left_anti")


def upsert_by_key(target: DataFrame, updates: DataFrame, keys=("id",), *, order) -> DataFrame:
    """``target`` with the rows of ``updates`` put in, or put in place of their key.

    Of updates with one key the first by ``order`` counts. Null keys are replaced too.
    """
    keys = list(keys)
    updates = keep_one(updates, keys, order)
    return without_keys(target, updates, keys).unionByName(updates)


def patch_by_key(
    rows: DataFrame, patches: DataFrame, keys=("id", "flight"), remove=()
) -> DataFrame:
    """Change named fields of the rows that ``patches`` addresses, and nothing else.

    Every non-key column of ``patches`` replaces (or adds) that field, also with null;
    the fields in ``remove`` become null. A patch without its row has no effect.
    """
    keys = list(keys)
    fields = [c for c in patches.columns if c not in keys]
    packed = keep_one(patches, keys, fields or keys).select(
        *keys, F.struct(F.lit(True).alias("_hit"), *fields).alias("_patch")
    )
    joined = rows.join(packed, keys, "left")
    hit = F.col("_patch").isNotNull()
    changed = {}
    for field in fields:
        old = F.col(field) if field in rows.columns else F.lit(None)
        changed[field] = F.when(hit, F.col(f"_patch.{field}")).otherwise(old)
    for field in remove:
        changed[field] = F.when(~hit, F.col(field))
    new = [f for f in fields if f not in rows.columns]
    return joined.withColumns(changed).select(*rows.columns, *new)
