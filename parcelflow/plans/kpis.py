"""The windowed KPIs, each declared once and used by batch and stream."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.functions.measures import fill_unknown
from parcelflow.model import ARRIVALS, DEPARTURES, FINANCIAL, SHIPMENT, TRACKING
from parcelflow.operators.windows import merge_partials, sliding_sums, windowed


def _one_of(names: tuple[str, ...]) -> str:
    return "event_type IN (" + ", ".join(f"'{name}'" for name in names) + ")"


@dataclass(frozen=True)
class Kpi:
    """Window keys and additive measures over one enriched topic."""

    name: str
    topic: str
    keys: tuple[str, ...]
    measures: Mapping[str, str]
    where: str | None = None
    sliding: bool = False

    @property
    def row_key(self) -> list[str]:
        return ["window_start", "window_end", *self.keys]


KPIS = {
    kpi.name: kpi
    for kpi in [
        Kpi(
            "kpi_financial",
            FINANCIAL,
            ("facility_id",),
            {
                "total_revenue_vnd": "sum(total_revenue)",
                "total_cod_vnd": "sum(if(event_type = 'cod_collected', cod_amount_vnd, 0L))",
                "cod_collected_count": "count_if(event_type = 'cod_collected')",
                "cod_committed_count": f"count_if({_one_of(('cod_collected', 'cod_failed'))})",
            },
            sliding=True,
        ),
        Kpi(
            "kpi_order_volume_facility",
            SHIPMENT,
            ("pickup_facility_id",),
            {"order_count": "count(1)"},
            where="event_type = 'shipment_created'",
        ),
        Kpi(
            "kpi_order_volume_partner_service",
            SHIPMENT,
            ("partner_id", "service_type_id"),
            {"order_count": "count(1)"},
            where="event_type = 'shipment_created'",
        ),
        Kpi(
            "kpi_facility_flow",
            TRACKING,
            ("facility_id",),
            {
                "inbound_count": f"count_if({_one_of(ARRIVALS)})",
                "outbound_count": f"count_if({_one_of(DEPARTURES)})",
                "failed_delivery_count": "count_if(event_type = 'failed_delivery')",
                "out_for_delivery_count": "count_if(event_type = 'dispatched_for_delivery')",
            },
        ),
        Kpi(
            "kpi_failure_reason",
            TRACKING,
            ("failure_reason_code",),
            {"failed_delivery_count": "count(1)"},
            where="event_type = 'failed_delivery'",
        ),
        Kpi(
            "kpi_returns",
            TRACKING,
            (),
            {"returned_count": "count_if(event_type = 'returned_to_sender')"},
        ),
    ]
}


def kpis_of(topic: str) -> list[Kpi]:
    return [kpi for kpi in KPIS.values() if kpi.topic == topic]


def compute_kpi(
    kpi: Kpi,
    enriched: DataFrame,
    window: str,
    slide: str,
    stamp: Column | None = None,
) -> DataFrame:
    """KPI rows of one enriched topic. Only valid rows count.

    ``stamp`` is the aggregate that gives ``ingested_at``, a maximum; the clock if not given.
    """
    base = enriched.filter("is_valid") if "is_valid" in enriched.columns else enriched
    if kpi.where:
        base = base.filter(kpi.where)
    measures = {name: F.expr(sql) for name, sql in kpi.measures.items()}
    stamps = {} if stamp is None else {"ingested_at": stamp}
    if not kpi.sliding:
        rows = windowed(base, kpi.keys, measures | stamps, window)
    elif base.isStreaming:
        rows = windowed(base, kpi.keys, measures | stamps, window, slide)
    else:
        rows = sliding_sums(base, kpi.keys, measures, window, slide, maxima=stamps)
    if stamp is None:
        rows = rows.withColumn("ingested_at", F.current_timestamp())
    return fill_unknown(rows)


def merged_kpi(kpi: Kpi, partials: DataFrame) -> DataFrame:
    """One row per window and key out of the partial rows of many batches."""
    return merge_partials(partials, kpi.row_key, list(kpi.measures))


def intake_stats(df: DataFrame, name: str = "intake") -> DataFrame:
    """Count all and invalid rows on the way through, without a job of their own."""
    return df.observe(
        name,
        F.count(F.lit(1)).alias("total"),
        F.count_if(~F.col("is_valid")).alias("invalid"),
    )


def quality_summary(flagged: DataFrame) -> DataFrame:
    """One row with the number of rows and of invalid rows."""
    return flagged.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(~F.col("is_valid")).alias("invalid_rows")
    )
