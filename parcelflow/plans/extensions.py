"""Documented measures beyond the core tables: roll-ups, checks, hub and delivery figures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.functions.dates import as_timestamp, seconds_between
from parcelflow.functions.measures import percent, ratio
from parcelflow.operators.lookup import lookup, small
from parcelflow.operators.windows import duration_s
from parcelflow.plans.journey import hub_steps


def region_rollup(rows: DataFrame, dims: Mapping[str, DataFrame], measures: Sequence[str]) -> DataFrame:
    """Totals by facility, branch, region and overall; ``level`` counts the open columns.

    ``dims`` holds the flattened facility dimension. Rows are added up per facility before
    the roll-up repeats them.
    """
    per_facility = rows.groupBy("facility_id").agg(*[F.sum(m).alias(m) for m in measures])
    place = dims["dim_facility"].select("facility_id", "branch_id", "region_id")
    placed = lookup(per_facility, place, ["facility_id"])
    return placed.rollup("region_id", "branch_id", "facility_id").agg(
        F.grouping_id().cast("int").alias("level"), *[F.sum(m).alias(m) for m in measures]
    )


def truth_order_volume(shipments: DataFrame) -> DataFrame:
    """Orders per pickup facility and day from the shipment fact."""
    return shipments.groupBy("pickup_facility_id", "created_date_id").agg(
        F.count(F.lit(1)).alias("order_count")
    )


def truth_partner_service(shipments: DataFrame) -> DataFrame:
    return shipments.groupBy("partner_id", "service_type_id").agg(
        F.count(F.lit(1)).alias("order_count")
    )


def truth_revenue(transactions: DataFrame) -> DataFrame:
    """Confirmed shipping revenue and collected cash per branch."""
    kind = F.col("revenue_type")
    return transactions.groupBy("branch_id").agg(
        F.sum(F.when(kind == "SHIPPING_FEE", F.col("revenue_amount_vnd")).otherwise(0)).alias(
            "revenue_vnd"
        ),
        F.sum("cod_amount_vnd").alias("cod_vnd"),
        F.count_if(kind == "COD_COLLECTION").alias("cod_collected_count"),
        F.count_if(kind.isin("COD_COLLECTION", "COD_FAILED")).alias("cod_committed_count"),
        ratio(
            F.count_if(kind == "COD_COLLECTION"),
            F.count_if(kind.isin("COD_COLLECTION", "COD_FAILED")),
        ).alias("cod_success_rate"),
    )


def truth_in_process(shipments: DataFrame) -> DataFrame:
    return shipments.filter("delivered_at IS NULL AND returned_at IS NULL").agg(
        F.count(F.lit(1)).alias("in_process")
    )


def deviation(
    realtime: DataFrame, batch: DataFrame, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Real-time against batch per key and measure, with the deviation in percent."""
    r = realtime.select(*keys, *[F.col(m).alias(f"r_{m}") for m in measures])
    b = batch.select(*keys, *[F.col(m).alias(f"b_{m}") for m in measures])
    both = r.join(b, list(keys), "full_outer")
    pairs = F.array(
        *[
            F.struct(
                F.lit(m).alias("measure"),
                F.coalesce(f"r_{m}", F.lit(0)).cast("double").alias("realtime"),
                F.coalesce(f"b_{m}", F.lit(0)).cast("double").alias("batch"),
            )
            for m in measures
        ]
    )
    long = both.select(*keys, F.inline(pairs))
    gap = F.abs(F.col("realtime") - F.col("batch"))
    return long.withColumn(
        "deviation_pct",
        F.when(gap == 0, 0.0).otherwise(F.round(F.try_divide(100 * gap, F.abs("batch")), 4)),
    )


def dwell_per_hub(dwells: DataFrame) -> DataFrame:
    """Number, mean and maximum of the stays at every hub."""
    return dwells.groupBy("hub_id").agg(
        F.count(F.lit(1)).alias("stays"),
        (F.sum("dwell_ms") / F.count(F.lit(1)) / 1000).alias("avg_dwell_s"),
        (F.max("dwell_ms") / 1000).alias("max_dwell_s"),
    )


def linehauls(events: DataFrame, bucket: str = "day") -> DataFrame:
    """Travel from a hub to the next: an arrival whose last hub event is a departure."""
    steps = hub_steps(events, bucket)
    legs = steps.filter(
        (F.col("event_type") == "arrived_at_hub") & (F.col("before.event_type") == "departed_hub")
    )
    return legs.select(
        "shipment_id",
        F.col("before.hub").alias("from_hub"),
        F.col("place").alias("to_hub"),
        F.col("before.event_time").alias("departed_at"),
        F.col("event_time").alias("arrived_at"),
        seconds_between(F.col("before.event_time"), F.col("event_time")).alias("linehaul_s"),
    )


def delays(shipments: DataFrame, as_of) -> DataFrame:
    """Days past the committed date, open shipments counted up to ``as_of``."""
    ended = F.coalesce("delivered_at", "returned_at")
    day = F.to_date(F.coalesce(ended, as_timestamp(as_of)))
    sla = F.try_to_date("sla_committed_date")
    late = F.datediff(day, sla)
    return shipments.filter(sla.isNotNull()).select(
        "shipment_id",
        ended.isNull().alias("in_transit"),
        F.greatest(late, F.lit(0)).alias("delay_days"),
        (late > 0).alias("sla_breach"),
    )


def delivery_rates(attempts: DataFrame) -> DataFrame:
    """First-attempt, re-delivery and failure shares over the attempt fact."""
    per_shipment = attempts.groupBy("shipment_id").agg(
        F.count(F.lit(1)).alias("tries"),
        F.count_if(F.col("result") == "FAILED").alias("failures"),
        F.max((F.col("attempt_no") == 1) & (F.col("result") == "SUCCESS")).alias("at_first"),
        F.max("attempt_no").alias("last_attempt"),
        F.max(F.col("result") == "SUCCESS").alias("reached"),
    )
    again = F.col("reached") & (F.col("last_attempt") > 1)
    return per_shipment.agg(
        F.count(F.lit(1)).alias("shipments"),
        F.sum("tries").alias("attempts"),
        percent(F.count_if("at_first"), F.count(F.lit(1))).alias("first_attempt_pct"),
        percent(F.count_if(again), F.count_if("reached")).alias("redelivery_pct"),
        percent(F.sum("failures"), F.sum("tries")).alias("failed_delivery_pct"),
    )


def return_share(shipments: DataFrame) -> DataFrame:
    return shipments.agg(
        F.count_if("is_returned").alias("returned"),
        F.count(F.lit(1)).alias("shipments"),
        percent(F.count_if("is_returned"), F.count(F.lit(1))).alias("return_rate_pct"),
    )


def _per_window(flow: DataFrame) -> DataFrame:
    return flow.groupBy("facility_id", "window_start", "window_end").agg(
        F.sum("inbound_count").alias("inbound_count"),
        F.sum("outbound_count").alias("outbound_count"),
        (F.sum("inbound_count") - F.sum("outbound_count")).alias("backlog"),
    )


def congestion(
    flow: DataFrame, dims: Mapping[str, DataFrame], window: str, limit: float = 0.8
) -> DataFrame:
    """Windows in which a facility passes the limit for the second time in a row.

    The window function runs over one row per facility and time window, never over events.
    """
    capacity = dims["dim_facility"].select("facility_id", "capacity_per_day")
    rows = lookup(_per_window(flow), capacity, ["facility_id"])
    full = rows.withColumn("full", F.col("backlog") > limit * F.col("capacity_per_day"))
    order = Window.partitionBy("facility_id").orderBy("window_start")
    adjacent = F.lag("window_start").over(order) + F.expr(
        f"INTERVAL {duration_s(window)} SECONDS"
    ) == F.col("window_start")
    again = F.col("full") & F.lag("full").over(order) & adjacent
    return full.withColumn("again", again).filter("again").select(
        "facility_id", "window_start", "window_end", "backlog", "capacity_per_day"
    )


def running_backlog(flow: DataFrame) -> DataFrame:
    """Backlog carried over all earlier windows, per facility."""
    so_far = (
        Window.partitionBy("facility_id")
        .orderBy("window_start")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return _per_window(flow).select(
        "facility_id",
        "window_start",
        "backlog",
        F.sum("backlog").over(so_far).alias("running_backlog"),
    )


def hub_throughput(route: DataFrame, window: str = "1 hour") -> DataFrame:
    """Hub arrivals and departures per window from the route fact."""
    hub = route.filter(F.col("event_type").isin("ARRIVED_AT_HUB", "DEPARTED_HUB"))
    return (
        hub.groupBy("facility_id", F.window("event_time", window).alias("w"))
        .agg(F.count(F.lit(1)).alias("throughput"))
        .select("facility_id", F.col("w.start").alias("window_start"), "throughput")
    )


def overdue_at_facility(tracking: DataFrame, as_of, limit_s: int = 3600) -> DataFrame:
    """Shipments still in a facility whose last arrival there is older than the limit."""
    arrived = F.col("event_type").startswith("arrived")
    moves = F.col("event_type").isin(
        "arrived_at_origin_post_office",
        "arrived_at_hub",
        "arrived_at_destination_post_office",
        "departed_origin_post_office",
        "departed_hub",
        "dispatched_for_delivery",
    )
    last = tracking.filter(moves).groupBy("facility_id", "shipment_id").agg(
        F.sum(F.when(arrived, 1).otherwise(-1)).alias("net"),
        F.max(F.when(arrived, F.col("event_time"))).alias("arrived_at"),
    )
    waited = F.unix_seconds(as_timestamp(as_of)) - F.unix_seconds("arrived_at")
    return (
        last.filter((F.col("net") > 0) & (waited > limit_s))
        .groupBy("facility_id")
        .agg(F.count(F.lit(1)).alias("overdue_shipments"))
    )


def delayed_by_facility(shipments: DataFrame) -> DataFrame:
    return (
        shipments.filter("is_delayed")
        .groupBy("current_facility_id")
        .agg(F.count(F.lit(1)).alias("delayed_shipments"))
    )


def unknown_keys(events: DataFrame, dim: DataFrame, column: str, dim_key: str) -> DataFrame:
    """Values of a key column that the dimension does not have, with their row counts."""
    counts = events.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    known = dim.select(F.col(dim_key).alias(column)).distinct()
    return counts.join(small(known), column, "left_anti")


def lateness_profile(events: DataFrame, watermark: str) -> DataFrame:
    """Delay between occurrence and arrival, and the share beyond the watermark."""
    late = F.unix_seconds("processing_time") - F.unix_seconds("event_time")
    rows = events.withColumn("lateness_s", late).filter("lateness_s IS NOT NULL")
    counted = rows.groupBy("topic", "lateness_s").agg(F.count(F.lit(1)).alias("n"))
    beyond = F.sum(F.when(F.col("lateness_s") > duration_s(watermark), F.col("n")).otherwise(0))
    return counted.groupBy("topic").agg(
        F.sum("n").alias("row_count"),
        F.percentile("lateness_s", F.lit(0.5), F.col("n")).alias("p50_s"),
        F.percentile("lateness_s", F.lit(0.95), F.col("n")).alias("p95_s"),
        F.max("lateness_s").alias("max_s"),
        percent(beyond, F.sum("n")).alias("beyond_watermark_pct"),
    )
