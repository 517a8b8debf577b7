"""Partial updates by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(
    base: DataFrame,
    changes: DataFrame,
    keys: list[str],
    order: str,
    update: list[str] | None = None,
) -> DataFrame:
    """`base` after applying `changes` in `order`.

    A key not in `base` takes the whole record. A known key takes only the `update`
    columns (all when None); a null in a change keeps the old value. Changes of one key
    fold into one row before the join, with partial aggregates, so a busy key is cheap.
    """
    columns = [c for c in base.columns if c not in keys]
    taken = columns if update is None else update
    folded = changes.groupBy(*keys).agg(
        *[
            (
                F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order)))
                if c in taken
                else F.min_by(F.col(c), F.col(order))
            ).alias(f"_new_{c}")
            for c in columns
        ],
        F.lit(True).alias("_changed"),
    )
    old = base.withColumn("_known", F.lit(True))
    joined = old.join(folded, keys, "full_outer")

    def value(c: str) -> Column:
        new = F.col(f"_new_{c}")
        if c in taken:
            return F.coalesce(new, F.col(c))
        return F.when(F.col("_known"), F.col(c)).otherwise(new)

    return joined.select(*keys, *[value(c).alias(c) for c in columns])
