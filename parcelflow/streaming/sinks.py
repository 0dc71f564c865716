"""Sinks of the streams: raw tables, KPI partials and final windows, journeys, alerts.

A sink for partial rows writes each batch to a partition of its own and overwrites it, so
a batch that is run again replaces its rows instead of adding them twice. The partition is
named after the query's checkpoint and the batch.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.functions.measures import fill_unknown
from parcelflow.model import ENVELOPE, TRANSPORT, columns_of, event_types, raw_columns
from parcelflow.plans.enrich import enrich
from parcelflow.plans.kpis import Kpi, compute_kpi
from parcelflow.sources.versions import DimensionVersions
from parcelflow.sources.warehouse import ARRIVED, RAW_TABLES, Warehouse
from parcelflow.streaming.tracker import alert_rows, journey_rows

BatchWriter = Callable[[DataFrame, int], None]
# Takes rows, table and the name of the batch they come from.
Append = Callable[[DataFrame, str, str], None]

BATCH = "source_batch"
PROGRESS_TABLE = "streaming_query_progress"
INTAKE_TABLE = "streaming_intake_stats"
DEAD_TABLE = "dead_letters"


def batch_name(checkpoint: str, query: str, batch_id: int) -> str:
    run = hashlib.sha256(f"{checkpoint}/{query}".encode()).hexdigest()[:12]
    return f"{run}-{batch_id}"


def jdbc_append(url: str, properties: Mapping[str, str]) -> Append:
    """Append rows to a table of a relational store."""

    def append(df: DataFrame, table: str, batch: str) -> None:
        df.write.jdbc(url, table, mode="append", properties=dict(properties))

    return append


def folder_append(root: str) -> Append:
    """One folder per table, one partition per query run and batch.

    A partition without rows states the columns, so a table that never got a row can be read.
    """
    stated = set()

    def append(df: DataFrame, table: str, batch: str) -> None:
        if table not in stated:
            none = df.sparkSession.createDataFrame([], df.schema)
            none.write.mode("overwrite").parquet(f"{root}/{table}/{BATCH}=none")
            stated.add(table)
        (
            df.withColumn(BATCH, F.lit(batch))
            .write.partitionBy(BATCH)
            .option("partitionOverwriteMode", "dynamic")
            .mode("overwrite")
            .parquet(f"{root}/{table}")
        )

    return append


def table_append(warehouse: Warehouse) -> Append:
    """The same in catalog tables."""

    def append(df: DataFrame, table: str, batch: str) -> None:
        rows = df.withColumn(BATCH, F.lit(batch))
        if not warehouse.exists(table):
            warehouse.like(rows, table, None, by=[BATCH])
        warehouse.overwrite_partitions(rows, table)

    return append


def _only_own_columns(df: DataFrame, topic: str) -> DataFrame:
    """Blank the columns an event's type does not have, as its own raw table would."""
    shared = set(columns_of(ENVELOPE)) | set(columns_of(TRANSPORT))
    owners: dict[str, list[str]] = {}
    for kind in event_types(topic):
        for name in raw_columns(topic, kind):
            owners.setdefault(name, []).append(kind)
    everyone = len(event_types(topic))
    return df.withColumns(
        {
            name: F.when(F.col("event_type").isin(kinds), F.col(name))
            for name, kinds in owners.items()
            if name not in shared and len(kinds) < everyone
        }
    )


def dead_rows(batch: DataFrame, topic: str) -> DataFrame:
    """(topic, reason, raw_value, kafka_partition, kafka_offset, ingest_time) of rows that no raw table of the topic can hold.

    UNREADABLE: no event type could be read from the text; NO_TYPE: it has none; UNKNOWN_TYPE: it isn't one of the topic.
    """
    kind = F.col("event_type")
    # A batch that was not decoded here has no text; its columns say the same.
    text = F.col("raw_value") if "raw_value" in batch.columns else F.to_json(F.struct("*"))
    unreadable = F.col("unreadable") if "unreadable" in batch.columns else F.lit(False)
    reason = F.when(kind.isNotNull(), "UNKNOWN_TYPE").when(unreadable, "UNREADABLE").otherwise("NO_TYPE")
    odd = batch.filter(kind.isNull() | ~kind.isin(event_types(topic)))
    return odd.select(
        F.lit(topic).alias("topic"), reason.alias("reason"), text.alias("raw_value"), "kafka_partition", "kafka_offset", "ingest_time"
    )


def create_dead_letters(warehouse: Warehouse) -> None:
    """One table for all topics; each writes partitions of its own."""
    columns = "reason string, raw_value string, kafka_partition int, kafka_offset bigint, ingest_time timestamp"
    warehouse.create(DEAD_TABLE, f"{columns}, topic string, {BATCH} string", None, by=["topic", BATCH])


def enriched_writer(
    versions: DimensionVersions, topic: str, table: str, append: Append, name: Callable[[int], str] = str
) -> BatchWriter:
    """A batch's events with their dimensions joined, as the newest version has them when the batch begins.

    ``dim_version`` says which that was. A batch run again reads the same version.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        number = versions.pinned(name(batch_id))
        rows = enrich(batch, topic, versions.read(number))
        append(rows.withColumn("dim_version", F.lit(number)), table, name(batch_id))

    return write


def raw_writer(warehouse: Warehouse, topic: str, name: Callable[[int], str] = str, keep: bool = False) -> BatchWriter:
    """Every event of a batch to the partition of its type, arrival and day, in one write; the others to the dead letters.

    Raw rows may be written again with a batch that is run again; dead letters are replaced. The batch is read once for each of the
    two, so it must have the same rows each time. ``keep`` holds it in between: for a stream, whose source is then read and
    counted once and whose intake cap bounds a batch.
    """
    table = RAW_TABLES[topic]
    create_dead_letters(warehouse)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn("ingest_time", F.coalesce("ingest_time", F.current_timestamp()))
        if keep:
            batch.persist()
        try:
            known = batch.filter(F.col("event_type").isin(event_types(topic)))
            placed = _only_own_columns(known, topic).withColumn(ARRIVED, warehouse.day_of(F.col("ingest_time")))
            warehouse.append(placed, table, "event_time")
            dead = dead_rows(batch, topic).withColumn(BATCH, F.lit(name(batch_id)))
            warehouse.overwrite_partitions(dead, DEAD_TABLE)
        finally:
            if keep:
                batch.unpersist()

    return write


def kpi_writer(
    kpis: Sequence[Kpi], window: str, slide: str, append: Append, name: Callable[[int], str] = str
) -> BatchWriter:
    """Partial windows of each batch, from one cached read of it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for kpi in kpis:
                append(compute_kpi(kpi, batch, window, slide), kpi.name, name(batch_id))
        finally:
            batch.unpersist()

    return write


def tracker_writer(append: Append, name: Callable[[int], str] = str) -> BatchWriter:
    """Journey rows and alerts of each batch to their tables."""
    tables = {"kpi_shipment_journey": journey_rows, "anomaly_alerts": alert_rows}

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for table, rows in tables.items():
                stamped = fill_unknown(rows(batch)).withColumn("ingested_at", F.current_timestamp())
                append(stamped, table, name(batch_id))
        finally:
            batch.unpersist()

    return write


def progress_writer(
    append: Append, run: str, table: str = PROGRESS_TABLE
) -> Callable[[DataFrame], None]:
    """Blocks of progress or intake rows to their table."""
    blocks = itertools.count()

    def write(rows: DataFrame) -> None:
        stamped = rows.withColumn("ingested_at", F.current_timestamp())
        append(stamped, table, f"{run}-{next(blocks)}")

    return write
