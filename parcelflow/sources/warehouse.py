"""Tables in a catalog: create, read a time range, append, replace, overwrite partitions.

File tables (parquet) carry a date column ``day`` as partition, or the first day of a
coarser ``grain`` where days hold too few rows for a file. On a catalog whose tables know
MERGE, set ``native_merge``; partitions are then ``days(ts)`` and rows are merged in place.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow import model
from parcelflow.functions.dates import as_timestamp

DAY = "day"
#: Partition of raw and cleaned tables by the day of arrival.
ARRIVED = "arrived_day"

# Fact table -> columns and time column.
FACT_TABLES = {
    "fact_shipment": (model.FACT_SHIPMENT, "created_at"),
    "fact_shipment_route": (model.FACT_ROUTE, "event_time"),
    "fact_delivery_attempt": (model.FACT_ATTEMPT, "attempt_ts"),
    "fact_hub_inventory": (model.FACT_INVENTORY, "snapshot_ts"),
    "fact_financial_transaction": (model.FACT_FINANCIAL, "transaction_ts"),
}

RAW_TABLES = {
    model.SHIPMENT: "raw_shipment",
    model.TRACKING: "raw_tracking",
    model.FINANCIAL: "raw_financial",
}


class Warehouse:
    """One database of one catalog."""

    def __init__(
        self,
        spark: SparkSession,
        database: str,
        location: str | None = None,
        catalog: str | None = None,
        provider: str = "parquet",
        native_merge: bool = False,
        grain: str = "day",
    ):
        self.spark = spark
        self.grain = grain
        self.database = f"{catalog}.{database}" if catalog else database
        self.provider = provider
        self.native_merge = native_merge
        place = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}{place}")

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def create(
        self, table: str, schema: T.StructType | str, ts: str | None, by: Sequence[str] = ()
    ) -> None:
        """Create an empty table partitioned by ``by`` and the day of ``ts``."""
        if self.exists(table):
            return
        empty = self.spark.createDataFrame([], schema)
        if self.native_merge:
            writer = empty.writeTo(self.name(table)).using(self.provider)
            parts = [F.col(c) for c in by] + ([F.days(ts)] if ts else [])
            (writer.partitionedBy(*parts) if parts else writer).create()
            return
        writer = self.with_day(empty, ts).write.format(self.provider)
        if self.provider == "parquet":
            # Kept with the table; every later write to it takes this codec.
            writer = writer.option("compression", "zstd")
        parts = [*by, DAY] if ts else list(by)
        (writer.partitionBy(*parts) if parts else writer).saveAsTable(self.name(table))

    def like(self, df: DataFrame, table: str, ts: str | None, by: Sequence[str] = ()) -> None:
        """Create an empty table with the columns of a frame."""
        self.create(table, df.schema, ts, by)

    def replace(self, table: str, df: DataFrame) -> None:
        """Create the table or replace all its rows."""
        if self.native_merge:
            df.writeTo(self.name(table)).using(self.provider).createOrReplace()
        else:
            df.write.format(self.provider).mode("overwrite").saveAsTable(self.name(table))

    def drop(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")

    def with_day(self, df: DataFrame, ts: str | None) -> DataFrame:
        if ts is None or self.native_merge:
            return df
        return df.withColumn(DAY, self.day_of(F.col(ts)))

    def day_of(self, at: Column) -> Column:
        """Partition of a time: its day, or the first of its grain."""
        return F.to_date(at if self.grain == "day" else F.date_trunc(self.grain, at))

    def stored(self, table: str) -> DataFrame:
        """The table with its partition column."""
        return self.spark.table(self.name(table))

    def without_partition_columns(self, df: DataFrame) -> DataFrame:
        """The frame without the columns that only place its rows."""
        return df.drop(DAY, ARRIVED)

    def read(self, table: str) -> DataFrame:
        return self.without_partition_columns(self.stored(table))

    def read_window(self, table: str, start=None, end=None, ts: str = "event_time") -> DataFrame | None:
        """Rows with start <= ts < end, an open side reading all; None without the table.

        The bounds are repeated on the partition column, so only their days are listed.
        """
        if not self.exists(table):
            return None
        df = self.stored(table)
        daily = DAY in df.columns
        if start is not None:
            bound = as_timestamp(start)
            df = df.filter(F.col(ts) >= bound)
            df = df.filter(F.col(DAY) >= self.day_of(bound)) if daily else df
        if end is not None:
            bound = as_timestamp(end)
            df = df.filter(F.col(ts) < bound)
            df = df.filter(F.col(DAY) <= self.day_of(bound)) if daily else df
        return self.without_partition_columns(df)

    def _in_table_order(self, df: DataFrame, table: str) -> DataFrame:
        return df.select(*self.stored(table).columns)

    def append(self, df: DataFrame, table: str, ts: str | None = None) -> None:
        out = self._in_table_order(self.with_day(df, ts), table)
        if self.native_merge:
            out.writeTo(self.name(table)).append()
        else:
            out.write.insertInto(self.name(table))

    def overwrite_partitions(self, df: DataFrame, table: str, spread: bool = True) -> None:
        """Replace the partitions the frame has rows for. Small files are merged, large split, for one shuffle of all rows.

        Without ``spread`` each task writes its own rows of every partition.

        The frame may read the table. The statement names the mode itself: ``insertInto`` drops a
        writer's options, so there the session's setting would decide, by default to empty the table.
        """
        parts = [c for c in self.partition_columns(table)]
        out = self._in_table_order(df, table)
        out = out.hint("rebalance", *parts) if spread else out
        if self.native_merge:
            out.writeTo(self.name(table)).overwritePartitions()
            return
        out.sparkSession.sql(
            f"INSERT OVERWRITE TABLE {self.name(table)} WITH (partitionOverwriteMode = 'dynamic') SELECT * FROM {{rows}}", rows=out
        )

    def partition_columns(self, table: str) -> list[str]:
        return [c.name for c in self.spark.catalog.listColumns(self.name(table)) if c.isPartition]

    def drop_partition(self, table: str, values: dict) -> None:
        spec = ", ".join(
            f"{k} = NULL" if v is None else f"{k} = '{v}'" for k, v in values.items()
        )
        self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS PARTITION ({spec})")


def in_partitions(columns: Sequence[str], rows: Sequence[Sequence]) -> Column:
    """Predicate on partition columns that the scan can prune with."""
    if not rows:
        return F.lit(False)
    by_head: dict[tuple, list] = {}
    for row in rows:
        by_head.setdefault(tuple(row[:-1]), []).append(row[-1])

    def equals(name: str, value) -> Column:
        return F.col(name).isNull() if value is None else F.col(name) == F.lit(value)

    def any_of(name: str, values: list) -> Column:
        known = [v for v in values if v is not None]
        test = F.col(name).isin(known) if known else F.lit(False)
        return test | F.col(name).isNull() if None in values else test

    branches = []
    for head, tails in by_head.items():
        tests = [equals(n, v) for n, v in zip(columns, head)] + [any_of(columns[-1], tails)]
        branches.append(reduce(lambda a, b: a & b, tests))
    return reduce(lambda a, b: a | b, branches)


def create_raw_tables(warehouse: Warehouse) -> None:
    """One raw table per topic, partitioned by event type, day of arrival and day."""
    for topic, table in RAW_TABLES.items():
        schema = T.StructType([*model.raw_schema(topic), T.StructField(ARRIVED, T.DateType())])
        warehouse.create(table, schema, "event_time", by=["event_type", ARRIVED])


def raw_events(warehouse: Warehouse, topic: str, event_type: str) -> DataFrame:
    """Raw rows of one event type with just that type's columns."""
    rows = warehouse.read(RAW_TABLES[topic]).filter(F.col("event_type") == event_type)
    return rows.select(*model.raw_columns(topic, event_type))


def create_fact_tables(warehouse: Warehouse) -> None:
    for table, (ddl, ts) in FACT_TABLES.items():
        warehouse.create(table, ddl, ts)
