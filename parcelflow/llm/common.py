"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.session import new_scratch

#: Characters that part words in the contracts of the operators: space and 0x09 to 0x0D.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read again: cuts the lineage, survives lost executors."""
    path = new_scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words; none in a null."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def utf8_crc32(text: Column) -> Column:
    """Unsigned CRC32 of the UTF-8 bytes; a null counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))


def id_remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, mod parts. A null id counts as the empty text."""
    return (utf8_crc32(doc_id.cast("string")) % parts).cast("int")


def positions(
    df: DataFrame, group: list[str], keys: list[str], sums: list[str] = (), label: str = "positions"
) -> DataFrame:
    """Add `position` (from 0) and exclusive running sums `before_<c>` in the order of keys per group.

    No group is sorted in one task: rows are range-partitioned, partition totals are added up,
    and only rows of one partition are numbered together. Nulls are values of their own.
    """
    spread = staged(
        df.repartitionByRange(*group, *keys).withColumn("_part", F.spark_partition_id()), label
    )
    at = ["_part", *group]
    totals = spread.groupBy(*at).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(f"_sum_{c}") for c in sums]
    )
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(c).alias(f"_at_{c}") for c in at],
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_first"),
        *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_base_{c}") for c in sums],
    )
    matched = spread.join(
        offsets, [F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in at]
    )
    within = Window.partitionBy(*[f"_at_{c}" for c in at]).orderBy(*keys)
    running = within.rowsBetween(Window.unboundedPreceding, -1)
    return matched.select(
        *df.columns,
        (F.row_number().over(within) - 1 + F.col("_first")).alias("position"),
        *[
            (F.coalesce(F.sum(c).over(running), F.lit(0)) + F.col(f"_base_{c}")).alias(f"before_{c}")
            for c in sums
        ],
    )


#: A key with more than a 1 / HOT_PARTS share of the rows is hot; so there are fewer than HOT_PARTS of them.
HOT_PARTS = 256


def join_spread(many: DataFrame, one: DataFrame, key: str) -> DataFrame:
    """Inner join on a non-null column that is unique in `one`, however the rows of `many` gather on it.

    The partners of hot keys, fewer than HOT_PARTS rows, are broadcast; all other rows are shuffled.
    `many` should be a written table, since it is read three times.
    """
    spark = many.sparkSession
    counts = many.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    least = many.count() // HOT_PARTS
    hot = [row[0] for row in counts.where(F.col("_rows") > max(least, 10_000)).select(key).collect()]
    if not hot:
        return many.join(one, key)
    hot = spark.createDataFrame([(k,) for k in hot], one.select(key).schema)
    partners = one.join(F.broadcast(hot), key, "left_semi")
    return (
        many.join(F.broadcast(partners), key)
        .unionByName(many.join(F.broadcast(hot), key, "left_anti").join(one, key))
    )


def text_batches(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Each Arrow batch with the UTF-8 bytes of one text column (None for null)."""
    for batch in batches:
        yield batch, batch.column(column).cast(pa.binary()).to_pylist()


def listed(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
    """Values of the lists, and offsets into them."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return lists.values.slice(offsets[0], offsets[-1] - offsets[0]), offsets - offsets[0]


def as_texts(column: pa.Array) -> pa.Array:
    """The column as valid UTF-8."""
    try:
        column.validate(full=True)
        return column
    except pa.ArrowInvalid:
        return pa.array([None if t is None else t.decode("utf-8", "replace") for t in column.cast(pa.binary()).to_pylist()], pa.string())


#: Bytes of texts that are taken apart at once; a longer text is taken alone.
BLOCK_BYTES = 16 << 20


def text_blocks(texts: pa.Array, size: int | None = None) -> Iterator[pa.Array]:
    """The texts, nulls as empty ones, in slices of about so many bytes (BLOCK_BYTES by default)."""
    texts = pc.fill_null(texts, "")
    upto_bytes, at = np.cumsum(pc.binary_length(texts).to_numpy()), 0
    while at < len(texts):
        base = upto_bytes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto_bytes, base + (size or BLOCK_BYTES), "right")))
        yield texts.slice(at, end - at)
        at = end


def log2_ceiling(n: int) -> int:
    return max(0, math.ceil(math.log2(max(1, n))))
