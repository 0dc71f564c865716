"""Left joins with dimension tables, broadcast only below a checked size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20
SALTS = 32


@dataclass(frozen=True)
class Lookup:
    """One dimension join: fact column, dimension column, columns to take."""

    table: str
    fact_key: str
    dim_key: str
    take: Mapping[str, str]  # output name -> dimension column

    def dimension(self, dims: Mapping[str, DataFrame]) -> DataFrame:
        picked = [F.col(source).alias(name) for name, source in self.take.items()]
        return dims[self.table].select(F.col(self.dim_key).alias("_dim_key"), *picked)


def input_bytes(df: DataFrame) -> int | None:
    """Sum of the optimizer's sizes of the tables a frame reads, None if not known.

    Chained key lookups do not add rows, so this bounds a dimension better than the
    optimizer's own product of join sides.
    """
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    except AttributeError:
        return None
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    size = input_bytes(df)
    return size is not None and size <= limit


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint if the size is known and small, else the frame as it is."""
    return F.broadcast(df) if fits_broadcast(df, limit) else df


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    limit: int = BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """``fact LEFT JOIN dim USING (on)`` that holds for small and for large dimensions.

    Small: broadcast. Large: a shuffle join whose hot keys are split, by the adaptive
    planner where it is on and by a salt where it is not (streams).
    """
    if fits_broadcast(dim, limit):
        return fact.join(F.broadcast(dim), list(on), "left")
    adaptive = fact.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
    if adaptive and not fact.isStreaming:
        return fact.join(dim, list(on), "left")
    salted = fact.withColumn("_salt", F.pmod(F.xxhash64(*fact.columns), F.lit(salts)))
    copies = dim.withColumn("_salt", F.expr(f"explode(sequence(0L, {salts - 1}L))"))
    return salted.join(copies, [*on, "_salt"], "left").drop("_salt")


def apply_lookups(
    df: DataFrame,
    dims: Mapping[str, DataFrame],
    specs: Sequence[Lookup],
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Run the joins in order; a later one may use a column an earlier one made.

    A join whose fact key is absent is skipped.
    """
    for spec in specs:
        if spec.fact_key not in df.columns:
            continue
        dim = spec.dimension(dims).withColumnRenamed("_dim_key", spec.fact_key)
        df = lookup(df, dim, [spec.fact_key], limit)
    return df
