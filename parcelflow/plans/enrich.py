"""Dimension joins and derived columns of the three topics, for batch and stream alike."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.functions.measures import (
    normalised_type,
    route_class,
    total_revenue,
    volumetric_gram,
)
from parcelflow.functions.quality import with_quality
from parcelflow.model import FINANCIAL, SHIPMENT, TRACKING
from parcelflow.operators.lookup import Lookup, apply_lookups


def _same(*names: str) -> dict[str, str]:
    return {name: name for name in names}


TOPIC_LOOKUPS = {
    FINANCIAL: [Lookup("dim_branch", "branch_id", "branch_id", _same("region_id"))],
    TRACKING: [
        Lookup("dim_facility", "facility_id", "facility_id", _same("branch_id", "province_id")),
        Lookup(
            "dim_route",
            "route_id",
            "route_id",
            _same("origin_hub_id", "destination_hub_id", "estimated_duration_hours"),
        ),
    ],
    SHIPMENT: [
        Lookup(
            "dim_facility", "pickup_facility_id", "facility_id", {"pickup_branch_id": "branch_id"}
        ),
        Lookup("dim_branch", "pickup_branch_id", "branch_id", {"pickup_region_id": "region_id"}),
        Lookup(
            "dim_service_type",
            "service_type_id",
            "service_type_id",
            _same(
                "speed_tier",
                "sla_inner_city_days",
                "sla_same_province_days",
                "sla_inter_province_days",
                "sla_remote_days",
            ),
        ),
        Lookup(
            "dim_province", "sender_province_id", "province_id", {"sender_is_remote": "is_remote"}
        ),
        Lookup(
            "dim_province",
            "receiver_province_id",
            "province_id",
            {"receiver_is_remote": "is_remote"},
        ),
    ],
}

# Cleaned events keep their own columns; what a dimension adds is prefixed.
CLEANED_LOOKUPS = [
    Lookup(
        "dim_facility",
        "facility_id",
        "facility_id",
        {"facility_branch_id": "branch_id", "facility_province_id": "province_id"},
    ),
    Lookup(
        "dim_route",
        "route_id",
        "route_id",
        {
            "route_destination_hub_id": "destination_hub_id",
            "route_est_duration_hours": "estimated_duration_hours",
        },
    ),
    Lookup(
        "dim_service_type",
        "service_type_id",
        "service_type_id",
        {"service_speed_tier": "speed_tier"},
    ),
]


def event_measures(df: DataFrame, topic: str) -> DataFrame:
    """The derived columns that need nothing but the event itself. KPIs need no more."""
    if topic == FINANCIAL:
        return df.withColumn("total_revenue", total_revenue())
    out = df.withColumn("event_type_norm", normalised_type(F.col("event_type")))
    if topic == SHIPMENT:
        out = out.withColumn("volumetric_weight_gram", volumetric_gram()).withColumn(
            "charged_weight_gram", F.greatest("weight_gram", "volumetric_weight_gram")
        )
    return out


def enrich(
    df: DataFrame, topic: str, dims: Mapping[str, DataFrame], stamp: Column | None = None
) -> DataFrame:
    """Left-join the topic's dimensions and add its derived columns."""
    out = event_measures(apply_lookups(df, dims, TOPIC_LOOKUPS[topic]), topic)
    if topic == SHIPMENT:
        remote = route_class(F.col("sender_is_remote"), F.col("receiver_is_remote"))
        out = out.withColumn("route_type", remote)
    return out.withColumn("enriched_at", F.current_timestamp() if stamp is None else stamp)


def enrich_cleaned(
    df: DataFrame, dims: Mapping[str, DataFrame], stamp: Column | None = None
) -> DataFrame:
    """Joins of the cleaned layer: only those whose key column the frame has."""
    out = apply_lookups(
        df.withColumn("event_type_norm", normalised_type(F.col("event_type"))),
        dims,
        CLEANED_LOOKUPS,
    )
    return out.withColumn("silver_loaded_at", F.current_timestamp() if stamp is None else stamp)


def deduplicated(df: DataFrame, watermark: str, bounded: bool = True) -> DataFrame:
    """Streaming dedup on event_id.

    ``bounded`` forgets an id once the watermark has passed it; without it the ids are
    kept for the life of the query.
    """
    marked = df.withWatermark("event_time", watermark)
    if bounded:
        return marked.dropDuplicatesWithinWatermark(["event_id"])
    return marked.dropDuplicates(["event_id"])


def flagged_stream(
    df: DataFrame, topic: str, watermark: str, bounded_dedup: bool = True
) -> DataFrame:
    """Parsed stream -> deduplicated, flagged stream."""
    return with_quality(deduplicated(df, watermark, bounded_dedup), topic)


def measured_stream(
    df: DataFrame, topic: str, watermark: str, bounded_dedup: bool = True
) -> DataFrame:
    """The same with the measures that need only the event itself, for KPIs."""
    return event_measures(flagged_stream(df, topic, watermark, bounded_dedup), topic)
