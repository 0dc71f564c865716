"""Cleaned events: validate, set bad rows aside, drop repeats, enrich, upsert."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.functions.quality import split_by_quality
from parcelflow.model import FINANCIAL, SHIPMENT, TOPICS, TRACKING, event_types
from parcelflow.operators.dedup import first_per_key
from parcelflow.operators.upsert import Rule, upsert
from parcelflow.plans.enrich import enrich_cleaned
from parcelflow.plans.expectations import expectation_results, write_results
from parcelflow.sources.arrivals import arrivals
from parcelflow.sources.warehouse import ARRIVED, RAW_TABLES, Warehouse

CLEAN_TABLES = {
    SHIPMENT: "silver_shipment",
    TRACKING: "silver_tracking",
    FINANCIAL: "silver_financial",
}
REJECTED_TABLES = {topic: f"{table}_rejected" for topic, table in CLEAN_TABLES.items()}

# The id first: sorts then mostly settle on it.
EVENT_KEY = ["event_id", "event_type"]
ARRIVAL_ORDER = ["event_time", "kafka_partition", "kafka_offset"]


def valid_events(raw: DataFrame, topic: str) -> tuple[DataFrame, DataFrame]:
    """Valid rows, one per event, and the rows set aside with their flags.

    Goods rules hold for creations only; other shipment events carry no goods.
    """
    known = raw.filter(F.col("event_type").isin(event_types(topic)))
    passed, rejected = split_by_quality(known, topic, goods_only_on="shipment_created")
    return first_per_key(passed, EVENT_KEY, ARRIVAL_ORDER), rejected


def cleaned(
    raw: DataFrame, topic: str, dims: Mapping[str, DataFrame], stamp: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """The same with the valid rows enriched."""
    valid, rejected = valid_events(raw, topic)
    return enrich_cleaned(valid, dims, stamp), rejected


def build_silver(
    warehouse: Warehouse,
    dims: Mapping[str, DataFrame],
    start,
    end,
    results_path: str | None = None,
    fixed_event_time: bool = False,
) -> None:
    """One run over the event times of [start, end). All event types of a topic go through one job.

    ``fixed_event_time`` promises that a repeated event id comes with the time it had
    before; only the days of the run are then searched for matches.
    """
    for topic in TOPICS:
        raw = warehouse.read_window(RAW_TABLES[topic], start, end)
        if raw is None or raw.isEmpty():
            continue
        _take_in(warehouse, dims, raw, topic, str(end), results_path, fixed_event_time)


def build_silver_arrivals(
    warehouse: Warehouse,
    dims: Mapping[str, DataFrame],
    results_path: str | None = None,
    fixed_event_time: bool = False,
    stamp: Column | None = None,
    **options,
) -> None:
    """One run over the raw rows that arrived since the last: none is missed for a late or unreadable event time.

    Rows without a time end among the rejected. ``stamp`` is what silver_loaded_at says, the run's
    own time by default; ``options`` are those of ``arrivals``.
    """
    for topic in TOPICS:
        with arrivals(warehouse, "silver", RAW_TABLES[topic], "ingest_time", **options) as taken:
            if taken.rows is not None:
                _take_in(warehouse, dims, taken.rows, topic, taken.run, results_path, fixed_event_time, stamp, _earliest)


def _earliest(name: str) -> Rule:
    """Of two rows of an event the one that comes first in order of time, whichever arrived first."""

    def rule(stored, incoming):
        order = lambda side: F.struct(*[side(c) for c in ARRIVAL_ORDER])
        return F.when(order(incoming) < order(stored), incoming(name)).otherwise(stored(name))

    return rule


def _take_in(
    warehouse, dims, raw, topic, run, results_path, fixed_event_time, stamp: Column | None = None, rule: Callable[[str], Rule] | None = None
) -> None:
    if results_path:
        write_results(expectation_results(raw, topic), results_path, run)
    # The upsert reads the rows twice; the run's own time must not move on in between.
    passed, rejected = cleaned(raw, topic, dims, _run_time(warehouse) if stamp is None else stamp)
    passed = passed.withColumn(ARRIVED, warehouse.day_of(F.col("silver_loaded_at")))
    upsert(
        warehouse,
        passed,
        CLEAN_TABLES[topic],
        EVENT_KEY,
        "event_time",
        {c: rule(c) for c in passed.columns if c not in EVENT_KEY} if rule else None,
        by=["event_type", ARRIVED],
        key_fixes_partition=fixed_event_time,
    )
    _keep_rejected(warehouse, rejected, topic, run)


def _run_time(warehouse: Warehouse) -> Column:
    micros = warehouse.spark.range(1).select(F.unix_micros(F.current_timestamp())).first()[0]
    return F.timestamp_micros(F.lit(micros))


def _keep_rejected(warehouse: Warehouse, rejected: DataFrame, topic: str, run: str) -> None:
    """Store the rows set aside, one partition per run so that a repeat replaces it."""
    table = REJECTED_TABLES[topic]
    stamped = rejected.withColumn("run_end", F.lit(run))
    if not warehouse.exists(table):
        warehouse.like(stamped, table, None, by=["run_end"])
    warehouse.overwrite_partitions(stamped, table)
