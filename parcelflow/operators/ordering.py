"""Order-dependent columns per key that survive a hot key.

A plain window puts all rows of a key into one task. Here rows are first partitioned by
(key, time bucket); what a bucket needs from earlier buckets comes from a table with one
row per key and bucket, so a hot key is spread over its buckets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def position_of(order: Sequence[str]) -> Column:
    """Sortable struct of the order columns with nulls last."""
    return F.struct(*[part for c in order for part in (F.col(c).isNull(), F.col(c))])


def carry_forward(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    values: Mapping[str, Column],
    bucket: Column,
) -> DataFrame:
    """Add, per name, the newest non-null value on any earlier row of the same key.

    ``order`` must be total within a key, and ``bucket`` must not decrease along it.
    """
    base = df.withColumns(dict({f"_in_{n}": v for n, v in values.items()}, _bucket=bucket))
    inside = (
        Window.partitionBy(key, "_bucket")
        .orderBy(*[F.col(c).asc_nulls_last() for c in order])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = base.withColumns(
        {f"_at_{n}": F.last(f"_in_{n}", ignorenulls=True).over(inside) for n in values}
    )

    position = position_of(order)
    ends = base.groupBy(key, "_bucket").agg(
        *[
            F.max_by(f"_in_{n}", F.when(F.col(f"_in_{n}").isNotNull(), position)).alias(f"_end_{n}")
            for n in values
        ]
    )
    earlier = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        F.col(key).alias("_key"),
        F.col("_bucket").alias("_key_bucket"),
        *[F.last(f"_end_{n}", ignorenulls=True).over(earlier).alias(f"_from_{n}") for n in values],
    )
    joined = local.join(
        carried,
        local[key].eqNullSafe(carried["_key"]) & local["_bucket"].eqNullSafe(carried["_key_bucket"]),
        "left",
    )
    out = {n: F.coalesce(f"_at_{n}", f"_from_{n}") for n in values}
    return joined.withColumns(out).select(*df.columns, *values)
