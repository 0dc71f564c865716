"""The dashboard queries as functions over the serving tables.

``start`` and ``end`` bound the time range where the panel has one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.functions.dates import as_timestamp
from parcelflow.functions.measures import percent
from parcelflow.operators.lookup import lookup
from parcelflow.plans import serving
from parcelflow.plans.serving import Tables

CONGESTED_PCT = 70


def in_range(df: DataFrame, column: str, start=None, end=None) -> DataFrame:
    """Rows from start to end, both included; an open side does not filter."""
    if start is not None:
        df = df.filter(F.col(column) >= as_timestamp(start))
    if end is not None:
        df = df.filter(F.col(column) <= as_timestamp(end))
    return df


def latest_window(df: DataFrame) -> DataFrame:
    """Rows of the newest window: a one-row maximum joined back."""
    newest = df.agg(F.max("window_start").alias("window_start"))
    return df.join(F.broadcast(newest), "window_start", "left_semi")


def avg_latency(t: Tables, as_of=None) -> DataFrame:
    return serving.latency_summary(t, as_of).select("avg_latency_s")


def p95_latency(t: Tables, as_of=None) -> DataFrame:
    return serving.latency_summary(t, as_of).select("p95_latency_s")


def data_age(t: Tables, as_of=None) -> DataFrame:
    return serving.latency_summary(t, as_of).select("data_age_s")


def in_process_total(t: Tables) -> DataFrame:
    return serving.in_process(t).agg(F.sum("in_process_count").alias("in_process"))


def _by_region(df: DataFrame, measure: str, name: str, start, end) -> DataFrame:
    return (
        in_range(df, "window_start", start, end)
        .groupBy(F.col("window_start").alias("time"), "region_name")
        .agg(F.sum(measure).alias(name))
        .orderBy("time", "region_name")
    )


def orders_by_region(t: Tables, start=None, end=None) -> DataFrame:
    return _by_region(serving.order_volume_facility(t), "order_count", "orders", start, end)


def revenue_by_region(t: Tables, start=None, end=None) -> DataFrame:
    """Sum per window start; sliding windows overlap, so rows must not be added over time."""
    return _by_region(serving.financial_facility(t), "total_revenue_vnd", "revenue", start, end)


def orders_total(t: Tables) -> DataFrame:
    return t["kpi_order_volume_facility"].agg(F.sum("order_count").alias("orders"))


def revenue_latest_window(t: Tables) -> DataFrame:
    return latest_window(t["kpi_financial"]).agg(F.sum("total_revenue_vnd").alias("revenue"))


def sla_compliance(t: Tables) -> DataFrame:
    return serving.sla_quality(t).select("sla_compliance_pct")


def first_attempt_success(t: Tables) -> DataFrame:
    return serving.sla_quality(t).select("first_attempt_success_pct")


def failed_delivery_pct(t: Tables) -> DataFrame:
    return t["kpi_facility_flow"].agg(
        percent(F.sum("failed_delivery_count"), F.sum("out_for_delivery_count")).alias(
            "failed_delivery_pct"
        )
    )


def return_pct(t: Tables) -> DataFrame:
    """Two totals of one row each, side by side."""
    returned = t["kpi_returns"].agg(F.sum("returned_count").alias("returned"))
    orders = t["kpi_order_volume_facility"].agg(F.sum("order_count").alias("orders"))
    both = returned.crossJoin(orders)
    return both.select(percent(F.col("returned"), F.col("orders")).alias("return_pct"))


def top_failure_reasons(t: Tables, start=None, end=None, n: int = 10) -> DataFrame:
    rows = in_range(t["kpi_failure_reason"], "window_start", start, end)
    return (
        rows.groupBy("failure_reason_code")
        .agg(F.sum("failed_delivery_count").alias("failed"))
        .orderBy(F.desc("failed"), "failure_reason_code")
        .limit(n)
    )


def anomalies_by_type(t: Tables) -> DataFrame:
    return (
        t["anomaly_alerts"]
        .groupBy("anomaly_type")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy(F.desc("cnt"), "anomaly_type")
    )


def segment_averages(t: Tables) -> DataFrame:
    titles = {
        "avg_e2e_transit_s": "E2E transit",
        "avg_pickup_lead_s": "Pickup lead",
        "avg_first_mile_s": "First mile",
        "avg_origin_po_dwell_s": "Origin PO dwell",
        "avg_total_hub_dwell_s": "Hub dwell",
        "avg_last_mile_s": "Last mile",
    }
    return serving.journey_times(t).select(*[F.col(c).alias(n) for c, n in titles.items()])


def facility_flow_latest(t: Tables, n: int = 50) -> DataFrame:
    rows = serving.facility_flow(t | {"kpi_facility_flow": latest_window(t["kpi_facility_flow"])})
    return (
        rows.orderBy(F.desc("facility_backlog"), "facility_id")
        .limit(n)
        .select(
            "facility_name",
            "branch_name",
            "region_name",
            "facility_throughput",
            "facility_backlog",
            F.round(F.col("failed_delivery_rate") * 100, 1).alias("failed_pct"),
            F.round("capacity_utilization_pct", 1).alias("cap_util_pct"),
        )
    )


def recent_anomalies(t: Tables, start=None, end=None, n: int = 100) -> DataFrame:
    """Newest alerts; the dimension is joined after the cut."""
    newest = (
        in_range(t["anomaly_alerts"], "detected_at", start, end)
        .orderBy(F.desc("detected_at"), "shipment_id", "anomaly_type", "detail")
        .limit(n)
    )
    return serving.anomaly_alerts(t | {"anomaly_alerts": newest}).select(
        "detected_at",
        "anomaly_type",
        "severity",
        "shipment_id",
        "facility_name",
        "region_id",
        "detail",
    )


def congested_facilities(t: Tables, limit_pct: float = CONGESTED_PCT, n: int = 50) -> DataFrame:
    rows = serving.facility_flow(t | {"kpi_facility_flow": latest_window(t["kpi_facility_flow"])})
    full = rows.filter(F.col("capacity_utilization_pct") > limit_pct)
    capacity = t["dim_facility"].select("facility_id", "capacity_per_day")
    return (
        lookup(full, capacity, ["facility_id"])
        .withColumn("cap_util_pct", F.round("capacity_utilization_pct", 1))
        .orderBy(F.desc("cap_util_pct"), "facility_id")
        .limit(n)
        .select(
            "facility_name",
            "branch_name",
            "region_name",
            "facility_backlog",
            "capacity_per_day",
            "cap_util_pct",
        )
    )


PANELS: dict[str, Callable[..., DataFrame]] = {
    "avg_latency": avg_latency,
    "p95_latency": p95_latency,
    "data_age": data_age,
    "in_process_total": in_process_total,
    "orders_by_region": orders_by_region,
    "revenue_by_region": revenue_by_region,
    "orders_total": orders_total,
    "revenue_latest_window": revenue_latest_window,
    "sla_compliance": sla_compliance,
    "first_attempt_success": first_attempt_success,
    "failed_delivery_pct": failed_delivery_pct,
    "return_pct": return_pct,
    "top_failure_reasons": top_failure_reasons,
    "anomalies_by_type": anomalies_by_type,
    "segment_averages": segment_averages,
    "facility_flow_latest": facility_flow_latest,
    "recent_anomalies": recent_anomalies,
    "congested_facilities": congested_facilities,
}
