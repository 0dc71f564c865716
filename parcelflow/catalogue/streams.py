"""Streams over the benchmark tables, drained and read back."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from parcelflow.catalogue.feeds import SCAN_SQL, SCHEMAS, _mapped, dimensions, scan_feed, scan_topics, table
from parcelflow.model import TRACKING, topic_schema
from parcelflow.operators.dedup import latest_per_key
from parcelflow.plans.enrich import deduplicated
from parcelflow.plans.kpis import KPIS, merged_kpi
from parcelflow.session import STREAM_CONF, new_scratch, session_conf
from parcelflow.settings import StateThresholds, StreamSettings
from parcelflow.sources.versions import DimensionVersions
from parcelflow.streaming.app import (
    enriched_table,
    start_enriched,
    start_final_kpi,
    start_partial_kpis,
    start_tracker,
)
from parcelflow.streaming.paced import PacedReplay
from parcelflow.streaming.progress import logged
from parcelflow.streaming.sinks import (
    BATCH,
    INTAKE_TABLE,
    PROGRESS_TABLE,
    folder_append,
    progress_writer,
)
from parcelflow.streaming.sweep import Run, sweep


#: Rows of the input for a state partition, for one of the tracker, whose expired timers' rows are held at once, and for a block.
PARTITION_ROWS, TRACKER_ROWS, BLOCK_ROWS = 500_000, 100_000, 256


def stream_conf(partitions: int = 8) -> dict[str, str]:
    return STREAM_CONF | {"spark.sql.shuffle.partitions": str(partitions)}


def sized_conf(rows: int, per_partition: int | None = None) -> dict[str, str]:
    """State partitions in proportion to the input: what a task keeps and gives back doesn't grow with it."""
    return stream_conf(max(8, -(-rows // (per_partition or PARTITION_ROWS))))


def scan_count(spark: SparkSession, sf_dir: str) -> int:
    """Number of scans, out of the file's footer."""
    return table(spark, sf_dir, "events").count()


def tracker_settings(rows: int, watermark: str, limits: StateThresholds) -> StreamSettings:
    return replace(settings("5 minutes", "1 minute", watermark, limits), tracker_blocks=max(8, rows // BLOCK_ROWS))


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait until an available-now query has stopped by itself."""
    query.awaitTermination()
    return query


def settings(window: str, slide: str, watermark: str, limits: StateThresholds | None = None):
    base = StreamSettings()
    return replace(
        base,
        window=window,
        slide=slide,
        watermarks={topic: watermark for topic in base.watermarks},
        union_watermark=watermark,
        available_now=True,
        thresholds=limits or base.thresholds,
    )


def scan_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of scans; the whole file is one batch."""
    rows = (
        spark.readStream.schema(SCHEMAS["events"])
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    return _mapped(rows, SCAN_SQL)


def replay(
    spark: SparkSession, sf_dir: str, start: Callable[[DataFrame], StreamingQuery], steps: int = 3
) -> Iterator[StreamingQuery]:
    """Stream the scans in order of time; gives the query of each step once it has drained.

    Equal ranges of the scans' times arrive one after the other, whatever months they span. Each
    is one batch of the same checkpoint, however many files it has. Scans without a time come first.
    """
    staged, path = new_scratch(spark, "replay-steps"), new_scratch(spark, "replay")
    scans = scan_feed(spark, sf_dir)
    at = F.unix_micros("event_time")
    low, high = scans.agg(F.min(at), F.max(at)).first()
    step = F.floor((at - (low or 0)) / (((high or 0) - (low or 0)) // steps + 1)).cast("int")
    scans.withColumn("step", F.coalesce(step, F.lit(0))).write.partitionBy("step").parquet(staged)
    schema = T.StructType([*scans.schema, T.StructField("step", T.IntegerType())])
    for number in range(steps):
        part = spark.read.schema(schema).parquet(staged).filter(F.col("step") == number)
        part.drop("step").write.mode("append").parquet(path)
        yield drain(start(spark.readStream.schema(scans.schema).parquet(path)))


def replay_topics(
    spark: SparkSession,
    feeds: Mapping[str, DataFrame],
    lags: Mapping[str, int],
    start: Callable[[dict[str, DataFrame]], StreamingQuery],
    steps: int = 3,
) -> Iterator[StreamingQuery]:
    """Stream several topics in order of time, each ``lags[topic]`` steps behind the others.

    A step is an equal number of whole UTC days, and one batch of the same checkpoint. Rows without
    a time come first. Further steps bring what lags.
    """
    days = [df.select(F.to_date("event_time").alias("day")) for df in feeds.values()]
    low, high = reduce(DataFrame.unionByName, days).agg(F.min("day"), F.max("day")).first()
    width = ((high - low).days + steps) // steps if low else 1
    staged, paths = {}, {}
    for topic, df in feeds.items():
        folder, paths[topic] = new_scratch(spark, "topic-steps"), new_scratch(spark, "topic")
        step = F.floor(F.date_diff(F.to_date("event_time"), F.lit(low)) / width).cast("int")
        lagging = F.coalesce(step, F.lit(0)) + lags.get(topic, 0)
        df.withColumn("step", lagging).write.partitionBy("step").parquet(folder)
        schema = T.StructType([*df.schema, T.StructField("step", T.IntegerType())])
        staged[topic] = spark.read.schema(schema).parquet(folder)
        spark.createDataFrame([], df.schema).write.parquet(paths[topic])
    for number in range(steps + max(lags.values(), default=0)):
        for topic, rows in staged.items():
            part = rows.filter(F.col("step") == number).drop("step")
            part.write.mode("append").parquet(paths[topic])
        streams = {t: spark.readStream.schema(df.schema).parquet(paths[t]) for t, df in feeds.items()}
        yield drain(start(streams))


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as tracking events, repeats of an id dropped under the watermark."""
    from parcelflow.catalogue.feeds import TRACKING_SQL

    path, checkpoint = new_scratch(spark, "dedup"), new_scratch(spark, "checkpoint")
    rows = (
        spark.readStream.schema(SCHEMAS["lineitem"])
        .option("pathGlobFilter", "lineitem.parquet")
        .parquet(sf_dir)
    )
    unique = deduplicated(_mapped(rows, TRACKING_SQL), "60 seconds").select("event_id")
    # The number of ids kept is read by nobody, and counting them costs a search at every write.
    uncounted = {"spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}
    with session_conf(spark, sized_conf(table(spark, sf_dir, "lineitem").count()) | uncounted):
        query = (
            unique.writeStream.format("parquet")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start(path)
        )
        drain(query)
    out = spark.read.schema("event_id string").parquet(path)
    return out.groupBy("event_id").agg(F.count(F.lit(1)).alias("copies"))


def final_flow(
    spark: SparkSession, sf_dir: str, window: str, watermark: str, steps: int = 3
) -> DataFrame:
    """Facility flow in final mode: each closed window once."""
    path, checkpoint = new_scratch(spark, "final"), new_scratch(spark, "checkpoint")
    kpi = KPIS["kpi_facility_flow"]
    conf = settings(window, window, watermark)

    def start(parsed: DataFrame) -> StreamingQuery:
        return start_final_kpi(kpi, parsed, folder_append(path), checkpoint, conf)

    with session_conf(spark, sized_conf(scan_count(spark, sf_dir))):
        for _ in replay(spark, sf_dir, start, steps):
            pass
    return spark.read.parquet(f"{path}/{kpi.name}").drop(BATCH, "ingested_at")


def partial_kpis(
    spark: SparkSession, sf_dir: str, window: str, watermark: str, steps: int = 3
) -> str:
    """Run the tracking KPIs in partial mode; gives the folder of their tables and progress."""
    path, checkpoint = new_scratch(spark, "partials"), new_scratch(spark, "checkpoint")
    append, conf = folder_append(path), settings(window, window, watermark)

    def start(parsed: DataFrame) -> StreamingQuery:
        scans = parsed.withColumn("failure_reason_code", F.lit(None).cast("string"))
        return start_partial_kpis(scans, TRACKING, append, checkpoint, conf)

    with session_conf(spark, sized_conf(scan_count(spark, sf_dir))), logged(spark, progress_writer(append, "replay")) as log:
        for query in replay(spark, sf_dir, start, steps):
            log.settle(query)
    return path


#: What changes after the second batch: later facilities are opened and every second one changes its branch.
MOVED_SQL = "CASE WHEN cast(substr(facility_id, 2) AS bigint) % 2 = 0 THEN 'B0' ELSE branch_id END"


def enriched_scans(spark: SparkSession, sf_dir: str, watermark: str) -> DataFrame:
    """The scans joined to dimensions of which a new version is published after the second of three batches."""
    path, checkpoint = new_scratch(spark, "enriched"), new_scratch(spark, "checkpoint")
    append, conf = folder_append(path), settings("6 hours", "6 hours", watermark)
    versions, dims = DimensionVersions(spark, new_scratch(spark, "dimensions")), dimensions(spark, sf_dir)
    places = dims["dim_facility"]
    opened = places.filter("cast(substr(facility_id, 2) AS bigint) % 5 <> 0")
    versions.publish({"dim_facility": opened, "dim_route": dims["dim_route"]})

    def start(parsed: DataFrame) -> StreamingQuery:
        return start_enriched(parsed, TRACKING, versions, append, checkpoint, conf)

    with session_conf(spark, sized_conf(scan_count(spark, sf_dir))):
        for number, _ in enumerate(replay(spark, sf_dir, start)):
            if number == 1:
                versions.publish({"dim_facility": places.withColumn("branch_id", F.expr(MOVED_SQL))})
    return spark.read.parquet(f"{path}/{enriched_table(TRACKING)}").drop(BATCH, "enriched_at")


def intake_tables(spark: SparkSession, sf_dir: str, watermark: str) -> dict[str, DataFrame]:
    """Run the KPIs of all topics over the scans, every fifth of them sent twice; gives the intake table."""
    path, checkpoint = new_scratch(spark, "intake"), new_scratch(spark, "checkpoint")
    append, conf = folder_append(path), settings("6 hours", "6 hours", watermark)
    twice = F.expr("CASE WHEN cast(substr(event_id, 2) AS bigint) % 5 = 0 THEN 2 ELSE 1 END")
    writers = progress_writer(append, "replay"), progress_writer(append, "replay", INTAKE_TABLE)
    with session_conf(spark, sized_conf(scan_count(spark, sf_dir))), logged(spark, *writers) as log:
        for topic, scans in scan_topics(spark, sf_dir).items():
            absent = [f for f in topic_schema(topic) if f.name not in scans.columns]
            sent = scans.select(
                "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent]
            ).withColumn("copy", F.explode(F.array_repeat(F.lit(1), twice)))

            def start(parsed: dict[str, DataFrame], topic=topic) -> StreamingQuery:
                return start_partial_kpis(parsed[topic], topic, append, checkpoint, conf)

            for query in replay_topics(spark, {topic: sent.drop("copy")}, {}, start):
                log.settle(query)
    return {INTAKE_TABLE: spark.read.parquet(f"{path}/{INTAKE_TABLE}")}


#: Every tenth scan comes three steps late. Runs: patient and impatient with late rows, slow and fast.
LATE_STEPS_SQL = "CASE WHEN cast(substr(event_id, 2) AS bigint) % 10 = 3 THEN 3 ELSE 0 END"
PACED_RUNS = (
    Run("trigger", watermark="365 days", window="6 hours", trigger="1 second"),
    Run("trigger", watermark="365 days", window="6 hours", trigger="25 seconds"),
    Run("watermark", watermark="60 seconds", window="6 hours", trigger="1 second"),
)


def paced_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facility flow of scans that arrive at a pace, under several triggers and watermarks."""
    scans = scan_feed(spark, sf_dir).withColumn("failure_reason_code", F.lit(None).cast("string"))
    feed = PacedReplay(spark, scans, behind=F.expr(LATE_STEPS_SQL))
    kpi = KPIS["kpi_facility_flow"]
    with session_conf(spark, sized_conf(scan_count(spark, sf_dir))):
        return sweep(spark, kpi, feed.open, scans, PACED_RUNS, feed.run, available_now=False)


def merged_flow(spark: SparkSession, path: str) -> DataFrame:
    kpi = KPIS["kpi_facility_flow"]
    return merged_kpi(kpi, spark.read.parquet(f"{path}/{kpi.name}")).drop("ingested_at")


def tracker_tables(
    spark: SparkSession, sf_dir: str, limits: StateThresholds, watermark: str
) -> dict[str, DataFrame]:
    """Run the tracker over all scans in one batch; gives its two tables."""
    path, checkpoint = new_scratch(spark, "tracker"), new_scratch(spark, "checkpoint")
    rows = scan_count(spark, sf_dir)
    with session_conf(spark, sized_conf(rows, TRACKER_ROWS)):
        drain(
            start_tracker(
                {TRACKING: scan_stream(spark, sf_dir)},
                dimensions(spark, sf_dir),
                folder_append(path),
                checkpoint,
                tracker_settings(rows, watermark, limits),
            )
        )
    return {
        name: spark.read.parquet(f"{path}/{name}")
        for name in ("kpi_shipment_journey", "anomaly_alerts")
    }


def tracker_topics(
    spark: SparkSession,
    sf_dir: str,
    limits: StateThresholds,
    watermark: str,
    scope: str = "topic",
    policy: str = "min",
    steps: int = 3,
) -> str:
    """Run the tracker over three topics of which tracking lags by a step; gives the folder of its tables.

    With a watermark per topic and the ``min`` policy the lagging topic holds the clock back. With ``max``,
    or one watermark after the union (``scope``), its rows come late. A topic that brings no row since the
    query was started holds ``min`` where it is.
    """
    path, checkpoint = new_scratch(spark, "tracker"), new_scratch(spark, "checkpoint")
    append, rows = folder_append(path), scan_count(spark, sf_dir)
    conf = replace(tracker_settings(rows, watermark, limits), watermark_scope=scope)
    dims = dimensions(spark, sf_dir)

    def start(parsed: dict[str, DataFrame]) -> StreamingQuery:
        return start_tracker(parsed, dims, append, checkpoint, conf)

    policy_conf = {"spark.sql.streaming.multipleWatermarkPolicy": policy}
    with (
        session_conf(spark, sized_conf(rows, TRACKER_ROWS) | policy_conf),
        logged(spark, progress_writer(append, "replay")) as log,
    ):
        for query in replay_topics(spark, scan_topics(spark, sf_dir), {TRACKING: 1}, start, steps):
            log.settle(query)
    return path


def last_journeys(spark: SparkSession, path: str) -> DataFrame:
    """The row of each shipment that the tracker wrote last, whatever time it states."""
    rows = spark.read.parquet(f"{path}/kpi_shipment_journey")
    return latest_per_key(rows, ["shipment_id"], ["ingested_at", "updated_at"])


def progress_of(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{PROGRESS_TABLE}")
