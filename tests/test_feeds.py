"""The feeds reach what the plans tell apart: no column of a journey is null in every row."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelflow.catalogue.feeds import scan_feed
from parcelflow.catalogue.queries import tracked
from parcelflow.streaming.tracker import ShipmentState

SF_DIR = "/root/testdata/sf0.01"


def test_every_branch_of_the_tracker_gets_scans(spark):
    types = {r["event_type"] for r in scan_feed(spark, SF_DIR).select("event_type").distinct().collect()}
    assert types == set(ShipmentState.HANDLERS)


def test_no_journey_column_is_null_throughout(spark):
    rows = tracked(spark, SF_DIR).journeys()
    filled = rows.agg(*[F.count(c).alias(c) for c in rows.columns]).first().asDict()
    assert all(filled.values()), filled
    statuses = {r["status"]: r["count"] for r in rows.groupBy("status").count().collect()}
    assert set(statuses) == {"DELIVERED", "RETURNED", "LOST", "STUCK"} | ({"IN_PROCESS"} & set(statuses))
    assert statuses["RETURNED"] > 20


def test_both_ends_and_kept_and_broken_promises_occur(spark):
    rows = tracked(spark, SF_DIR).journeys().filter("status IN ('DELIVERED', 'RETURNED')")
    seen = rows.agg(*[F.count_distinct(c).alias(c) for c in ("sla_met", "sla_breach", "first_attempt_success", "is_redelivery")]).first()
    assert tuple(seen) == (2, 2, 2, 2)
