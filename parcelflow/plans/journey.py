"""Shipment journeys and anomalies computed over a complete set of events.

Gives, for a finished input, what the streaming tracker ends with when it sees all events
of a shipment at once and the watermark then reaches ``as_of``.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow.functions.dates import as_timestamp, seconds_between
from parcelflow.functions.measures import column_or_null
from parcelflow.model import ANOMALY, EXPRESS_TIERS, JOURNEY, TERMINAL, columns_of
from parcelflow.operators.dedup import top_per_key
from parcelflow.operators.lookup import Lookup, apply_lookups
from parcelflow.operators.ordering import carry_forward, position_of
from parcelflow.settings import StateThresholds

UNIFIED = (
    "shipment_id string, event_id string, event_type string, event_time timestamp, "
    "sequence_no int, facility_id string, pickup_facility_id string, route_id string, "
    "attempt_no int, service_type_id string, sla_committed_date string"
)

# event_id makes the order total where time and sequence tie.
EVENT_ORDER = ["event_time", "sequence_no", "event_id"]

STATE_LOOKUPS = [
    Lookup("dim_route", "route_id", "route_id", {"route_hub_id": "destination_hub_id"}),
    Lookup("dim_service_type", "service_type_id", "service_type_id", {"tier": "speed_tier"}),
]


def aligned(df: DataFrame) -> DataFrame:
    """The columns the tracker reads; absent ones as typed nulls."""
    return df.select(
        *[
            column_or_null(df, f.name, f.dataType.simpleString())
            for f in T.StructType.fromDDL(UNIFIED)
        ]
    )


def unify(topics: Mapping[str, DataFrame], watermarks: Mapping[str, str] | None = None) -> DataFrame:
    """Union of the topics' valid rows, each under its own watermark if given."""
    out = None
    for topic, df in topics.items():
        part = aligned(df)
        if watermarks is not None:
            part = part.withWatermark("event_time", watermarks[topic])
        out = part if out is None else out.unionByName(part)
    return out


def with_state_lookups(unified: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Add the hub a route leads to and the speed tier of a service."""
    return apply_lookups(unified, dims, STATE_LOOKUPS)


def _is(*types: str) -> Column:
    return F.col("event_type").isin(*types)


def _place() -> Column:
    return F.coalesce(F.nullif("facility_id", F.lit("")), F.nullif("pickup_facility_id", F.lit("")))


def hub_steps(events: DataFrame, bucket: str = "day") -> DataFrame:
    """Hub events with the hub event ``before`` each and the speed tier known by then."""
    hub = F.when(
        _is("arrived_at_hub", "departed_hub"),
        F.struct("event_type", "event_time", _place().alias("hub")),
    )
    tier = F.when(_is("shipment_created"), F.coalesce("tier", F.lit("STANDARD")))
    steps = events.filter(_is("arrived_at_hub", "departed_hub", "shipment_created"))
    paired = carry_forward(
        steps,
        "shipment_id",
        EVENT_ORDER,
        {"before": hub, "known_tier": tier},
        F.date_trunc(bucket, "event_time"),
    )
    return paired.filter(_is("arrived_at_hub", "departed_hub")).withColumn("place", _place())


def hub_dwells(events: DataFrame, bucket: str = "day") -> DataFrame:
    """One row per departure that follows an arrival with no hub event between them."""
    arrived_at = F.col("before.event_time")
    stays = hub_steps(events, bucket).filter(
        _is("departed_hub") & (F.col("before.event_type") == "arrived_at_hub")
    )
    return stays.select(
        "shipment_id",
        F.col("before.hub").alias("hub_id"),
        arrived_at.alias("arrived_at"),
        F.col("event_time").alias("departed_at"),
        (F.unix_millis("event_time") - F.unix_millis(arrived_at)).alias("dwell_ms"),
        F.col("known_tier").alias("tier"),
    )


def shipment_progress(events: DataFrame, dwells: DataFrame) -> DataFrame:
    """Everything the journey row needs, in one aggregation per shipment."""
    position = position_of(EVENT_ORDER)
    created = _is("shipment_created")
    attempts = _is("dispatched_for_delivery", "delivered", "failed_delivery")

    def last_time(event_type: str) -> Column:
        return F.max(F.when(_is(event_type), F.col("event_time")))

    feed = events.unionByName(dwells.select("shipment_id", "dwell_ms"), allowMissingColumns=True)
    seen = F.col("event_type").isNotNull()
    return feed.groupBy("shipment_id").agg(
        F.min(F.when(created, F.col("event_time"))).alias("created_at"),
        F.max_by("sla_committed_date", F.when(created, position)).alias("sla"),
        last_time("picked_up").alias("picked_up_at"),
        last_time("arrived_at_origin_post_office").alias("origin_in_at"),
        last_time("departed_origin_post_office").alias("origin_out_at"),
        last_time("dispatched_for_delivery").alias("dispatched_at"),
        F.coalesce(F.sum("dwell_ms"), F.lit(0)).alias("dwell_ms"),
        F.max("event_time").alias("last_at"),
        F.max_by("event_type", F.when(seen, position)).alias("last_type"),
        F.max_by(_place(), F.when(_place().isNotNull(), position)).alias("place"),
        F.max(F.when(attempts, F.col("attempt_no"))).alias("attempt"),
        F.max_by(
            F.struct("event_type", "event_time"), F.when(_is(*TERMINAL), position)
        ).alias("end"),
    )


def _silence(as_of, limits: StateThresholds) -> tuple[Column, Column]:
    """Whether an open shipment counts as stuck, and as lost, at ``as_of``."""
    if as_of is None:
        return F.lit(False), F.lit(False)
    quiet = F.unix_millis(as_timestamp(as_of)) - F.unix_millis("last_at")
    open_ = F.col("end").isNull()
    return open_ & (quiet > limits.stuck_s * 1000), open_ & (quiet > limits.lost_s * 1000)


def _after(seconds: int) -> Column:
    return F.timestamp_millis(F.unix_millis("last_at") + seconds * 1000)


def journeys(progress: DataFrame, limits: StateThresholds, as_of=None) -> DataFrame:
    """Newest journey row of every shipment."""
    stuck, lost = _silence(as_of, limits)
    done_at = F.col("end.event_time")
    done = F.col("end").isNotNull()
    delivered = done & (F.col("end.event_type") == "delivered")
    done_date = F.date_format(done_at, "yyyy-MM-dd")
    sla = F.col("sla")
    attempt = F.coalesce("attempt", F.lit(1))

    def when_done(value: Column) -> Column:
        return F.when(done, value)

    def flag(condition: Column) -> Column:
        return when_done(F.coalesce(condition, F.lit(False)).cast("int"))

    columns = {
        "status": F.when(delivered, "DELIVERED")
        .when(done, "RETURNED")
        .when(lost, "LOST")
        .when(stuck, "STUCK")
        .otherwise("IN_PROCESS"),
        "current_facility": F.col("place"),
        "e2e_transit_s": when_done(seconds_between(F.col("created_at"), done_at)),
        "pickup_lead_s": when_done(seconds_between(F.col("created_at"), F.col("picked_up_at"))),
        "first_mile_s": when_done(seconds_between(F.col("picked_up_at"), F.col("origin_in_at"))),
        "origin_po_dwell_s": when_done(
            seconds_between(F.col("origin_in_at"), F.col("origin_out_at"))
        ),
        "total_hub_dwell_s": when_done(F.col("dwell_ms") / 1000.0),
        "last_mile_s": F.when(delivered, seconds_between(F.col("dispatched_at"), done_at)),
        "sla_committed_date": when_done(sla),
        "delivered_date": F.when(delivered, done_date),
        "sla_met": flag(delivered & (done_date <= sla)),
        "sla_breach": flag(done_date > sla),
        "attempt_count": when_done(F.nullif("attempt", F.lit(0))),
        "first_attempt_success": flag(delivered & (attempt.isin(0, 1))),
        "is_redelivery": flag(attempt > 1),
        "updated_at": F.when(done, done_at)
        .when(lost, _after(limits.lost_s))
        .when(stuck, _after(limits.stuck_s))
        .otherwise(F.col("last_at")),
    }
    named = progress.select("shipment_id", *[c.alias(n) for n, c in columns.items()])
    return named.select(*columns_of(JOURNEY))


def _alert(df: DataFrame, kind: str, severity: str, at, facility, detail: Column) -> DataFrame:
    return df.select(
        F.col(at).alias("detected_at") if isinstance(at, str) else at.alias("detected_at"),
        "shipment_id",
        (F.col(facility) if isinstance(facility, str) else facility).alias("facility_id"),
        F.lit(kind).alias("anomaly_type"),
        F.lit(severity).alias("severity"),
        detail.alias("detail"),
    )


def anomalies(
    events: DataFrame,
    dwells: DataFrame,
    progress: DataFrame,
    limits: StateThresholds,
    as_of=None,
) -> DataFrame:
    """All alert rows. Alert names, severities and texts are fixed values."""
    off_route = _alert(
        events.filter(
            _is("arrived_at_hub") & _place().isNotNull() & (F.col("route_hub_id") != _place())
        ),
        "ABNORMAL_ROUTE",
        "WARNING",
        "event_time",
        _place(),
        F.format_string("arrived %s, route %s expects %s", _place(), "route_id", "route_hub_id"),
    )

    limit = F.when(F.col("tier").isin(*EXPRESS_TIERS), limits.express_dwell_s).otherwise(
        limits.standard_dwell_s
    )
    long_dwell = _alert(
        dwells.filter(F.col("dwell_ms") > limit * 1000),
        "LONG_HUB_DWELL",
        "WARNING",
        "departed_at",
        "hub_id",
        F.format_string(
            "dwell %ds > %ds (%s)",
            F.bround(F.col("dwell_ms") / 1000.0, 0).cast("bigint"),
            limit,
            F.coalesce("tier", F.lit("None")),
        ),
    )

    failed = events.filter(_is("failed_delivery"))
    order = [F.col(c).asc_nulls_last() for c in EVENT_ORDER]
    first_two = top_per_key(failed, ["shipment_id"], order, 2)
    second = (
        first_two.groupBy("shipment_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max_by(F.struct("event_time", _place().alias("place")), position_of(EVENT_ORDER)).alias("e"),
        )
        .filter("n = 2")
    )
    failures = _alert(
        second, "MULTIPLE_FAILURES", "WARNING", "e.event_time", "e.place", F.lit("2nd failed_delivery")
    )

    out = off_route.unionByName(long_dwell).unionByName(failures)
    if as_of is None:
        return out
    stuck, lost = _silence(as_of, limits)
    for kind, severity, hit, seconds in (
        ("STUCK_SHIPMENT", "WARNING", stuck, limits.stuck_s),
        ("SUSPECTED_LOST", "CRITICAL", lost, limits.lost_s),
    ):
        text = F.format_string(f"no event for >{seconds}s; last=%s", "last_type")
        out = out.unionByName(
            _alert(progress.filter(hit), kind, severity, _after(seconds), "place", text)
        )
    return out.select(*columns_of(ANOMALY))


@dataclass(frozen=True)
class Tracking:
    """A complete event set with what journeys and alerts are made from."""

    events: DataFrame
    limits: StateThresholds
    as_of: object = None
    bucket: str = "day"

    @cached_property
    def dwells(self) -> DataFrame:
        return hub_dwells(self.events, self.bucket)

    @cached_property
    def progress(self) -> DataFrame:
        return shipment_progress(self.events, self.dwells)

    def journeys(self) -> DataFrame:
        return journeys(self.progress, self.limits, self.as_of)

    def alerts(self) -> DataFrame:
        return anomalies(self.events, self.dwells, self.progress, self.limits, self.as_of)


def track(
    unified: DataFrame,
    dims: Mapping[str, DataFrame],
    limits: StateThresholds | None = None,
    as_of=None,
    bucket: str = "day",
) -> Tracking:
    """Journeys and alerts of a complete event set."""
    return Tracking(with_state_lookups(unified, dims), limits or StateThresholds(), as_of, bucket)
