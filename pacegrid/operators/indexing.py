"""Position of a row in its group without gathering the group in one task."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def positional_index(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    slice_by: Column,
    name: str = "index",
) -> DataFrame:
    """1-based position of each row among its `keys`, ordered by `order`.

    `slice_by` must not decrease along `order` (a truncation of its first column).
    Rows are ranked inside a slice, then moved up by the rows of earlier slices, so the
    largest sort is one slice of one group. Only slices with an offset are joined back.
    """
    sliced = df.withColumn("_slice", slice_by)
    slice_keys = [*keys, "_slice"]
    local = sliced.withColumn(
        "_local", F.row_number().over(Window.partitionBy(*slice_keys).orderBy(*order))
    )
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(*slice_keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_offset", F.sum("_rows").over(before))
        .filter(F.col("_offset") > 0)
        .select(*[F.col(k).alias(f"_o{i}") for i, k in enumerate(slice_keys)], "_offset")
    )
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_o{i}")) for i, k in enumerate(slice_keys)])
    position = (F.col("_local") + F.coalesce("_offset", F.lit(0))).cast("long")
    return local.join(offsets, same, "left").select(*df.columns, position.alias(name))
