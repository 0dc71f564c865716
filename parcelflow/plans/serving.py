"""Serving views over the KPI, journey, alert and progress tables.

Each view takes the tables by name and returns a frame. KPI tables hold partial rows, so a
view adds them up before it joins a dimension: the join then sees one row per window and
key.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.functions.dates import as_timestamp, whole_seconds
from parcelflow.functions.measures import percent, ratio
from parcelflow.operators.dedup import latest_per_key
from parcelflow.operators.lookup import lookup, small
from parcelflow.operators.sketches import SKETCH_K, merged, quantile, rank_error, sketch
from parcelflow.plans.kpis import KPIS, merged_kpi

Tables = Mapping[str, DataFrame]

PLACE = ["facility_name", "facility_type", "branch_id", "branch_name", "region_id", "region_name"]
DONE = ("DELIVERED", "RETURNED")


def _merged(t: Tables, name: str) -> DataFrame:
    return merged_kpi(KPIS[name], t[name])


def _with_place(df: DataFrame, t: Tables, columns: list[str]) -> DataFrame:
    return lookup(df, t["dim_facility"].select("facility_id", *columns), ["facility_id"])


def order_volume_facility(t: Tables) -> DataFrame:
    rows = _merged(t, "kpi_order_volume_facility").withColumnRenamed(
        "pickup_facility_id", "facility_id"
    )
    return _with_place(rows, t, PLACE).select(
        "window_start", "window_end", "facility_id", *PLACE, "order_count"
    )


def order_volume_partner_service(t: Tables) -> DataFrame:
    rows = _merged(t, "kpi_order_volume_partner_service")
    rows = lookup(rows, t["dim_partner"].select("partner_id", "partner_name"), ["partner_id"])
    rows = lookup(
        rows, t["dim_service_type"].select("service_type_id", "service_name"), ["service_type_id"]
    )
    return rows.select(
        "window_start",
        "window_end",
        "partner_id",
        "service_type_id",
        "service_name",
        "partner_name",
        "order_count",
    )


def financial_facility(t: Tables) -> DataFrame:
    sums = list(KPIS["kpi_financial"].measures)
    rate = ratio(F.col("cod_collected_count"), F.col("cod_committed_count"))
    return _with_place(_merged(t, "kpi_financial"), t, PLACE).select(
        "window_start",
        "window_end",
        "facility_id",
        *PLACE,
        *sums,
        rate.alias("cod_collection_success_rate"),
    )


def facility_flow(t: Tables) -> DataFrame:
    rows = _with_place(_merged(t, "kpi_facility_flow"), t, [*PLACE, "capacity_per_day"])
    backlog = F.col("inbound_count") - F.col("outbound_count")
    return rows.select(
        "window_start",
        "window_end",
        "facility_id",
        *PLACE,
        (F.col("inbound_count") + F.col("outbound_count")).alias("facility_throughput"),
        backlog.alias("facility_backlog"),
        "failed_delivery_count",
        "out_for_delivery_count",
        ratio(F.col("failed_delivery_count"), F.col("out_for_delivery_count")).alias(
            "failed_delivery_rate"
        ),
        (ratio(backlog, F.col("capacity_per_day")) * 100).alias("capacity_utilization_pct"),
    )


def failure_reason(t: Tables) -> DataFrame:
    return _merged(t, "kpi_failure_reason").drop("ingested_at")


def returns(t: Tables) -> DataFrame:
    return _merged(t, "kpi_returns").drop("ingested_at")


def return_rate(t: Tables) -> DataFrame:
    window = ["window_start", "window_end"]
    orders = t["kpi_order_volume_facility"].groupBy(*window).agg(
        F.sum("order_count").alias("order_count")
    )
    return (
        returns(t)
        .join(orders, window, "left")
        .select(
            *window,
            "returned_count",
            "order_count",
            percent(F.col("returned_count"), F.col("order_count")).alias("return_rate_pct"),
        )
    )


def shipment_journey(t: Tables) -> DataFrame:
    """Newest row of every shipment."""
    order = ["updated_at"]
    if "ingested_at" in t["kpi_shipment_journey"].columns:
        order.append("ingested_at")
    return latest_per_key(t["kpi_shipment_journey"], ["shipment_id"], order)


def shipment_status_dist(t: Tables) -> DataFrame:
    return shipment_journey(t).groupBy("status").agg(F.count(F.lit(1)).alias("shipment_count"))


def in_process(t: Tables) -> DataFrame:
    place = ["facility_name", "branch_id", "branch_name", "region_id", "region_name"]
    counts = (
        shipment_journey(t)
        .filter("status = 'IN_PROCESS'")
        .groupBy(F.col("current_facility").alias("facility_id"))
        .agg(F.count(F.lit(1)).alias("in_process_count"))
    )
    return _with_place(counts, t, place).select("facility_id", *place, "in_process_count")


def _completed(t: Tables) -> DataFrame:
    return shipment_journey(t).filter(F.col("status").isin(*DONE))


def journey_times(t: Tables) -> DataFrame:
    segments = [
        "e2e_transit_s",
        "pickup_lead_s",
        "first_mile_s",
        "origin_po_dwell_s",
        "total_hub_dwell_s",
        "last_mile_s",
    ]
    return _completed(t).agg(
        F.count(F.lit(1)).alias("completed_count"), *[F.avg(s).alias(f"avg_{s}") for s in segments]
    )


def sla_quality(t: Tables) -> DataFrame:
    delivered = F.col("status") == "DELIVERED"
    shares = {
        "sla_compliance_pct": "sla_met",
        "first_attempt_success_pct": "first_attempt_success",
        "redelivery_pct": "is_redelivery",
    }
    return _completed(t).agg(
        F.count_if(delivered).alias("delivered_count"),
        F.count_if(F.col("status") == "RETURNED").alias("returned_count"),
        F.sum("sla_breach").alias("sla_breach_count"),
        *[
            percent(F.sum(F.when(delivered, F.col(flag))), F.count_if(delivered)).alias(name)
            for name, flag in shares.items()
        ],
    )


def anomaly_alerts(t: Tables) -> DataFrame:
    place = ["facility_name", "branch_id", "region_id"]
    return _with_place(t["anomaly_alerts"], t, place).select(
        "detected_at",
        "shipment_id",
        "facility_id",
        *place,
        "anomaly_type",
        "severity",
        "detail",
    )


def anomaly_summary(t: Tables) -> DataFrame:
    return (
        t["anomaly_alerts"]
        .groupBy("anomaly_type", "severity")
        .agg(F.count(F.lit(1)).alias("alert_count"))
    )


def latency_shipment(t: Tables) -> DataFrame:
    rows = shipment_journey(t).filter(F.col("status").isin("IN_PROCESS", *DONE))
    return rows.select(
        "shipment_id",
        "status",
        "updated_at",
        "ingested_at",
        whole_seconds(F.col("updated_at"), F.col("ingested_at")).alias("pipeline_latency_s"),
    )


def _now(as_of) -> Column:
    return F.current_timestamp() if as_of is None else as_timestamp(as_of)


LAG = "pipeline_latency_s"


def _latency(rows: DataFrame, keys: list[str], count: str, stamp: str, as_of) -> DataFrame:
    """Exact figures per keys. Rows of equal latency are counted before the quantiles are taken."""
    counted = rows.groupBy(*keys, LAG).agg(F.count(F.lit(1)).alias("n"), F.max(stamp).alias("newest"))
    known = F.sum(F.when(F.col(LAG).isNotNull(), F.col("n")))
    return counted.groupBy(*keys).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias(count),
        F.round(F.try_divide(F.sum(F.col(LAG) * F.col("n")), known), 2).alias("avg_latency_s"),
        F.round(F.percentile(LAG, F.lit(0.50), F.col("n")), 2).alias("p50_latency_s"),
        F.round(F.percentile(LAG, F.lit(0.95), F.col("n")), 2).alias("p95_latency_s"),
        F.max(LAG).alias("max_latency_s"),
        F.max("newest").alias("last_ingested_at"),
        (F.unix_seconds(_now(as_of)) - F.unix_seconds(F.max("newest"))).alias("data_age_s"),
    )


def latency_summary(t: Tables, as_of=None) -> DataFrame:
    """Latency of the journey rows."""
    return _latency(latency_shipment(t), [], "sample_count", "ingested_at", as_of)


def latency_kpi(t: Tables, as_of=None) -> DataFrame:
    """Write time against end time of every closed window, over all KPI tables."""
    out = None
    for name in KPIS:
        part = (
            t[name]
            .filter(F.col("window_end") < _now(as_of))
            .groupBy("window_start", "window_end")
            .agg(F.max("ingested_at").alias("last_ingested_at"))
            .select(F.lit(name).alias("kpi_name"), "*")
        )
        out = part if out is None else out.unionByName(part)
    return out.withColumn(
        "pipeline_latency_s", whole_seconds(F.col("window_end"), F.col("last_ingested_at"))
    )


def latency_kpi_summary(t: Tables, as_of=None) -> DataFrame:
    return _latency(latency_kpi(t, as_of), ["kpi_name"], "window_count", "last_ingested_at", as_of)


def latency_parts(rows: DataFrame, keys: list, stamp: str, k: int = SKETCH_K) -> DataFrame:
    """Partial latency figures per keys that can be kept and added up: counts, sums and a quantile sketch."""
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(LAG).alias("known"),
        F.sum(LAG).alias("total_s"),
        F.max(LAG).alias("longest_s"),
        F.max(stamp).alias("newest"),
        sketch(F.col(LAG), k).alias("latency_sketch"),
    )


def latency_merged(
    parts: DataFrame, keys: list[str], count: str, as_of=None, k: int = SKETCH_K
) -> DataFrame:
    """The figures of ``_latency`` out of parts; p50 and p95 within ``rank_error`` of their ranks."""
    added = parts.groupBy(*keys).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias(count),
        F.sum("known").alias("known"),
        F.sum("total_s").alias("total_s"),
        F.max("longest_s").alias("max_latency_s"),
        F.max("newest").alias("last_ingested_at"),
        merged(F.col("latency_sketch"), k).alias("latency_sketch"),
    )
    return added.select(
        *keys,
        count,
        F.round(F.try_divide("total_s", "known"), 2).alias("avg_latency_s"),
        quantile("latency_sketch", 0.50).alias("p50_latency_s"),
        quantile("latency_sketch", 0.95).alias("p95_latency_s"),
        "max_latency_s",
        "last_ingested_at",
        (F.unix_seconds(_now(as_of)) - F.unix_seconds("last_ingested_at")).alias("data_age_s"),
    )


def held_ranks(rows: DataFrame, summary: DataFrame, keys: list[str], k: int = SKETCH_K) -> DataFrame:
    """Add whether p50 and p95 of a summary lie within twice the stated error of their ranks among all rows."""
    shares = {0.50: "p50", 0.95: "p95"}
    asked = small(summary.select(*keys, *[f"{p}_latency_s" for p in shares.values()]))
    counts = [F.count(LAG).alias("n")]
    for p in shares.values():
        counts.append(F.count_if(F.col(LAG) < F.col(f"{p}_latency_s")).alias(f"{p}_below"))
        counts.append(F.count_if(F.col(LAG) <= F.col(f"{p}_latency_s")).alias(f"{p}_upto"))
    ranked = rows.join(asked, keys).groupBy(*keys).agg(*counts)
    slack = 2 * rank_error(k)
    flags = [
        ((F.col(f"{p}_below") <= (q + slack) * F.col("n")) & (F.col(f"{p}_upto") >= (q - slack) * F.col("n"))).alias(f"{p}_within")
        for q, p in shares.items()
    ]
    return summary.join(ranked.select(*keys, *flags), keys, "left")


def stream_intake_summary(t: Tables) -> DataFrame:
    """Rows read, distinct rows and invalid rows per query. A batch reported twice counts once."""
    batches = latest_per_key(t["streaming_intake_stats"], ["query_id", "batch_id"], ["event_ts", "ingested_at"])
    return batches.groupBy("query_name").agg(
        F.sum("num_input_rows").alias("input_rows"),
        F.sum("total").alias("distinct_rows"),
        F.sum("invalid").alias("invalid_rows"),
    )


def stream_progress_summary(t: Tables) -> DataFrame:
    rps, took = "processed_rows_per_second", "batch_duration_ms"
    return (
        t["streaming_query_progress"]
        .groupBy("query_name")
        .agg(
            F.count(F.lit(1)).alias("batch_count"),
            F.round(F.avg(rps), 1).alias("avg_processed_rps"),
            F.round(F.percentile(rps, F.lit(0.50)), 1).alias("p50_processed_rps"),
            F.round(F.percentile(rps, F.lit(0.95)), 1).alias("p95_processed_rps"),
            F.round(F.avg(took), 0).alias("avg_batch_ms"),
            F.round(F.percentile(took, F.lit(0.95)), 0).alias("p95_batch_ms"),
            F.sum("num_input_rows").alias("total_input_rows"),
            F.sum("num_dropped_late_rows").alias("total_dropped_late_rows"),
            F.max("state_num_rows_total").alias("max_state_rows"),
            F.max("state_memory_bytes").alias("max_state_memory_bytes"),
            F.max("event_ts").alias("last_event_ts"),
        )
    )


VIEWS: dict[str, Callable[..., DataFrame]] = {
    "v_order_volume_facility": order_volume_facility,
    "v_order_volume_partner_service": order_volume_partner_service,
    "v_financial_facility": financial_facility,
    "v_facility_flow": facility_flow,
    "v_failure_reason": failure_reason,
    "v_returns": returns,
    "v_return_rate": return_rate,
    "v_shipment_journey": shipment_journey,
    "v_shipment_status_dist": shipment_status_dist,
    "v_in_process": in_process,
    "v_journey_times": journey_times,
    "v_sla_quality": sla_quality,
    "v_anomaly_alerts": anomaly_alerts,
    "v_anomaly_summary": anomaly_summary,
    "v_latency_shipment": latency_shipment,
    "v_latency_summary": latency_summary,
    "v_latency_kpi": latency_kpi,
    "v_latency_kpi_summary": latency_kpi_summary,
    "v_stream_progress_summary": stream_progress_summary,
}


def register_views(t: Tables, names=None) -> None:
    """Make the views queryable by name in SQL."""
    for name in names or VIEWS:
        VIEWS[name](t).createOrReplaceTempView(name)
