"""Starts the streams: raw tables and KPIs per topic, and one tracker over all topics."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parcelflow.functions.quality import with_quality
from parcelflow.plans.enrich import flagged_stream, measured_stream
from parcelflow.plans.journey import unify, with_state_lookups
from parcelflow.plans.kpis import Kpi, compute_kpi, intake_stats, kpis_of
from parcelflow.settings import StreamSettings
from parcelflow.sources.versions import DimensionVersions
from parcelflow.sources.warehouse import Warehouse, create_raw_tables
from parcelflow.streaming.progress import ProgressLog
from parcelflow.streaming.sinks import (
    INTAKE_TABLE,
    Append,
    batch_name,
    create_dead_letters,
    enriched_writer,
    kpi_writer,
    progress_writer,
    raw_writer,
    tracker_writer,
)
from parcelflow.streaming.tracker import tracked_stream


def short(topic: str) -> str:
    return topic.replace(".", "_")


def _start(df: DataFrame, name: str, mode: str, writer, checkpoint: str, settings) -> StreamingQuery:
    return (
        df.writeStream.queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", f"{checkpoint}/{name}")
        .foreachBatch(writer)
        .trigger(**settings.trigger_args())
        .start()
    )


def start_raw(parsed, topic, warehouse, checkpoint, settings) -> StreamingQuery:
    query = f"raw_{short(topic)}"
    writer = raw_writer(warehouse, topic, partial(batch_name, checkpoint, query), keep=True)
    return _start(parsed, query, "append", writer, checkpoint, settings)


def start_partial_kpis(parsed, topic, append: Append, checkpoint, settings) -> StreamingQuery:
    """Low-latency mode: partial windows per batch, added up on read."""
    events = intake_stats(measured_stream(parsed, topic, settings.watermarks[topic]))
    query = f"kpi_{short(topic)}"
    name = partial(batch_name, checkpoint, query)
    writer = kpi_writer(kpis_of(topic), settings.window, settings.slide, append, name)
    return _start(events, query, "append", writer, checkpoint, settings)


def start_final_kpi(kpi: Kpi, parsed, append: Append, checkpoint, settings) -> StreamingQuery:
    """Final mode: one row per window and key, once the watermark has closed the window."""
    events = measured_stream(parsed, kpi.topic, settings.watermarks[kpi.topic])
    rows = compute_kpi(kpi, events, settings.window, settings.slide)
    query = f"final_{kpi.name}"

    def write(batch: DataFrame, batch_id: int) -> None:
        append(batch, kpi.name, batch_name(checkpoint, query, batch_id))

    return _start(rows, query, "append", write, checkpoint, settings)


def enriched_table(topic: str) -> str:
    return f"enriched_{short(topic)}"


def start_enriched(
    parsed, topic, versions: DimensionVersions, append: Append, checkpoint, settings
) -> StreamingQuery:
    """Deduplicated, flagged events with the topic's dimensions; a change of these counts from the next batch on."""
    events = flagged_stream(parsed, topic, settings.watermarks[topic])
    query = enriched_table(topic)
    name = partial(batch_name, checkpoint, query)
    writer = enriched_writer(versions, topic, query, append, name)
    return _start(events, query, "append", writer, checkpoint, settings)


def unified_stream(parsed: Mapping[str, DataFrame], settings: StreamSettings) -> DataFrame:
    """Valid events of all topics. Not deduplicated: the tracker sees what arrives."""
    valid = {t: with_quality(df, t).filter("is_valid") for t, df in parsed.items()}
    if settings.watermark_scope == "topic":
        return unify(valid, settings.watermarks)
    return unify(valid).withWatermark("event_time", settings.union_watermark)


def _fixed_blocks(spark: SparkSession, checkpoint: str, wanted: int) -> int:
    """The number of blocks that the first start of a checkpoint noted: shipments must stay in theirs."""
    path = f"{checkpoint}/tracker-blocks"
    spark.range(1).select(F.lit(wanted).alias("blocks")).write.mode("ignore").parquet(path)
    return spark.read.schema("blocks int").parquet(path).first().blocks


def start_tracker(parsed, dims, append: Append, checkpoint, settings) -> StreamingQuery:
    events = with_state_lookups(unified_stream(parsed, settings), dims)
    blocks = _fixed_blocks(events.sparkSession, checkpoint, settings.tracker_blocks)
    output = tracked_stream(events, settings.thresholds, blocks)
    writer = tracker_writer(append, partial(batch_name, checkpoint, "tracker"))
    return _start(output, "tracker", "update", writer, checkpoint, settings)


def start_all(
    warehouse: Warehouse,
    parsed: Mapping[str, DataFrame],
    dims: Mapping[str, DataFrame],
    append: Append,
    checkpoint: str,
    settings: StreamSettings | None = None,
) -> tuple[list[StreamingQuery], ProgressLog]:
    """All queries: raw and KPI per topic, and the tracker; and the log of their progress."""
    settings = settings or StreamSettings()
    create_raw_tables(warehouse)
    create_dead_letters(warehouse)
    run = uuid.uuid4().hex[:12]
    log = ProgressLog(
        warehouse.spark, progress_writer(append, run), progress_writer(append, run, INTAKE_TABLE)
    )
    warehouse.spark.streams.addListener(log)
    started = []
    for topic, stream in parsed.items():
        started.append(start_raw(stream, topic, warehouse, checkpoint, settings))
        started.append(start_partial_kpis(stream, topic, append, checkpoint, settings))
    started.append(start_tracker(parsed, dims, append, checkpoint, settings))
    return started, log


def await_streams(queries: list[StreamingQuery], log: ProgressLog, every_s: float = 30) -> None:
    """Wait until all queries have ended, writing their progress meanwhile.

    The first query that fails stops the others and raises.
    """
    running = list(queries)
    try:
        while running:
            if running[0].awaitTermination(every_s):
                running.pop(0)
            for query in running:
                if query.exception() is not None:
                    raise query.exception()
            log.flush()
    finally:
        for query in running:
            query.stop()
        log.flush()
