"""Event feeds and dimensions derived from the benchmark tables.

Every feed maps each row of its table to one event. The same expressions, as SQL, stand in
``catalogue.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.model import FINANCIAL, SHIPMENT, TRACKING
from parcelflow.sources.dimensions import flat_facilities


# Known schemas save a footer scan per table.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


CREATED_SQL = {
    "event_id": "CASE WHEN o_orderkey % 97 <> 0 THEN concat('O', o_orderkey) END",
    "event_type": "'shipment_created'",
    "event_time": "CASE WHEN o_orderkey % 83 <> 0 "
    "THEN o_orderdate + make_dt_interval(0, cast(o_custkey % 24 AS int), "
    "cast(o_orderkey % 60 AS int), 0) END",
    "processing_time": "o_orderdate + make_dt_interval(0, cast(o_custkey % 24 AS int), "
    "cast(o_orderkey % 60 AS int), o_custkey % 90)",
    "schema_version": "'v1.0'",
    "shipment_id": "CASE WHEN o_orderkey % 89 <> 0 THEN concat('S', o_orderkey) END",
    "partner_id": "concat('C', o_custkey)",
    "service_type_id": "o_orderpriority",
    "sender_province_id": "concat('P', o_custkey % 25)",
    "sender_district_id": "concat('D', o_custkey % 100)",
    "sender_ward_id": "concat('W', o_custkey % 500)",
    "pickup_facility_id": "concat('F', o_custkey % 10)",
    "receiver_province_id": "concat('P', o_orderkey % 28)",
    "receiver_district_id": "concat('D', o_orderkey % 100)",
    "receiver_ward_id": "concat('W', o_orderkey % 500)",
    "delivery_facility_id": "concat('F', o_orderkey % 10)",
    "declared_value_vnd": "cast(floor(o_totalprice) AS bigint) - 5000",
    "weight_gram": "cast(CASE WHEN o_custkey % 41 <> 40 THEN (o_custkey % 41) * 100 - 100 END AS int)",
    "length_cm": "cast(10 + o_orderkey % 50 AS double)",
    "width_cm": "cast(10 + o_custkey % 30 AS double)",
    "height_cm": "cast(5 + o_orderkey % 20 AS double)",
    "item_category": "o_orderstatus",
    "is_fragile": "o_orderstatus = 'F'",
    "cod_amount_vnd": "cast(floor(o_totalprice / 2) AS bigint)",
    "shipping_fee_vnd": "cast(floor(o_totalprice / 100) AS bigint)",
    "fuel_surcharge_vnd": "cast(floor(o_totalprice / 1000) AS bigint)",
    "remote_area_fee_vnd": "cast(0 AS bigint)",
    "insurance_fee_vnd": "cast(floor(o_totalprice / 500) AS bigint)",
    "total_fee_vnd": "cast(floor(o_totalprice / 50) AS bigint)",
    "payment_by": "CASE WHEN o_orderkey % 2 = 0 THEN 'SENDER' ELSE 'RECEIVER' END",
    "sla_committed_date": "date_format(date_add(o_orderdate, cast(o_orderkey % 9 - 1 AS int)), 'yyyy-MM-dd')",
    "kafka_partition": "cast(o_custkey % 32 AS int)",
    "kafka_offset": "o_orderkey",
}

TRACKING_TYPE_SQL = """CASE l_returnflag || l_linestatus
  WHEN 'AF' THEN 'arrived_at_hub'
  WHEN 'AO' THEN CASE WHEN l_linenumber <= 3 THEN 'arrived_at_origin_post_office'
                      ELSE 'arrived_at_destination_post_office' END
  WHEN 'NF' THEN 'departed_hub'
  WHEN 'NO' THEN CASE WHEN l_linenumber <= 2 THEN 'departed_origin_post_office'
                      WHEN l_linenumber <= 4 THEN 'sorted_at_hub'
                      ELSE 'dispatched_for_delivery' END
  WHEN 'RF' THEN 'failed_delivery'
  ELSE CASE WHEN l_linenumber <= 5 THEN 'delivered' ELSE 'returned_to_sender' END
END"""

_LINE_TIME = (
    "l_shipdate + make_dt_interval(0, l_linenumber, cast(l_partkey % 60 AS int), {seconds})"
)

TRACKING_SQL = {
    "event_id": "concat('T', l_orderkey, '-', l_linenumber)",
    "event_type": TRACKING_TYPE_SQL,
    "event_time": _LINE_TIME.format(seconds="0"),
    "processing_time": _LINE_TIME.format(seconds="l_partkey % 120"),
    "schema_version": "'v1.0'",
    "shipment_id": "concat('S', l_orderkey)",
    "facility_id": "concat('F', l_suppkey)",
    "facility_type": "CASE WHEN l_suppkey % 3 = 0 THEN 'HUB' ELSE 'POST_OFFICE' END",
    "sequence_no": "l_linenumber",
    "route_id": "CASE WHEN l_returnflag || l_linestatus IN ('AF', 'NF') THEN concat('RT', l_suppkey) END",
    "destination_facility_id": "cast(NULL AS string)",
    "shipper_id": "CASE WHEN l_returnflag = 'R' THEN concat('H', l_partkey % 50) END",
    "attempt_no": "CASE WHEN l_returnflag = 'R' THEN 1 + l_linenumber % 3 END",
    "recipient_relation": "cast(NULL AS string)",
    "failure_reason_code": "CASE WHEN l_returnflag || l_linestatus = 'RF' AND l_partkey % 6 < 5 "
    "THEN concat('REASON_', l_partkey % 6) END",
    "failure_reason_detail": "cast(NULL AS string)",
    "kafka_partition": "cast(l_suppkey % 64 AS int)",
    "kafka_offset": "l_partkey * 100000 + l_suppkey",
}

FINANCIAL_SQL = {
    "event_id": "concat('M', l_orderkey, '-', l_linenumber)",
    "event_type": "CASE WHEN l_returnflag = 'A' THEN 'shipping_fee_confirmed' "
    "WHEN l_returnflag = 'N' THEN 'fee_adjusted' "
    "WHEN l_linestatus = 'O' THEN 'cod_collected' ELSE 'cod_failed' END",
    "event_time": _LINE_TIME.format(seconds="0"),
    "processing_time": _LINE_TIME.format(seconds="l_partkey % 45"),
    "schema_version": "'v1.0'",
    "shipment_id": "concat('S', l_orderkey)",
    "facility_id": "concat('F', l_suppkey)",
    "branch_id": "concat('B', l_suppkey % 27)",
    "partner_id": "concat('C', l_partkey % 100)",
    "service_type_id": "CASE WHEN l_linenumber % 2 = 0 THEN '1-URGENT' ELSE '5-LOW' END",
    "revenue_type": "CASE WHEN l_returnflag = 'A' THEN 'SHIPPING_FEE' END",
    "revenue_amount_vnd": "CASE WHEN l_returnflag = 'A' THEN cast(floor(l_extendedprice) AS bigint) END",
    "shipping_fee_vnd": "CASE WHEN l_returnflag = 'A' THEN cast(floor(l_extendedprice) AS bigint) END",
    "attempt_no": "CASE WHEN l_returnflag = 'R' THEN 1 + l_linenumber % 3 END",
    "cod_amount_vnd": "CASE WHEN l_returnflag = 'R' THEN cast(floor(l_extendedprice) AS bigint) END",
    "adjustment_amount_vnd": "CASE WHEN l_returnflag = 'N' THEN cast(l_quantity AS bigint) - 25 END",
    "kafka_partition": "cast(l_suppkey % 16 AS int)",
    "kafka_offset": "l_partkey * 100000 + l_suppkey",
}

# Every stage of a shipment that the tracker knows; terminal events of both kinds.
SCAN_TYPE_SQL = """CASE event_type WHEN 'signup' THEN 'shipment_created'
  WHEN 'click' THEN CASE cast(event_id % 4 AS int) WHEN 1 THEN 'picked_up'
    WHEN 2 THEN 'arrived_at_origin_post_office' ELSE 'arrived_at_hub' END
  WHEN 'view' THEN CASE cast(event_id % 4 AS int) WHEN 1 THEN 'departed_origin_post_office'
    WHEN 2 THEN 'dispatched_for_delivery' ELSE 'departed_hub' END
  WHEN 'error' THEN 'failed_delivery'
  ELSE CASE WHEN event_id % 5 = 0 THEN 'returned_to_sender' ELSE 'delivered' END END"""

# events: a month of scans with times to the microsecond; a shipment is a user's day.
SCAN_SQL = {
    "event_id": "concat('E', event_id)",
    "event_type": SCAN_TYPE_SQL,
    "event_time": "date_trunc('second', ts)",
    "shipment_id": "concat(user_id, '-', date_format(ts, 'yyyyMMdd'))",
    "sequence_no": "cast(event_id % 7 AS int)",
    "facility_id": "concat('F', from_json(props, 'k int').k)",
    "route_id": "CASE WHEN event_type = 'click' THEN concat('RT', from_json(props, 'k int').k) END",
    "attempt_no": "CASE WHEN event_type IN ('error', 'purchase') OR event_type = 'view' AND event_id % 4 = 2 "
    "THEN cast(1 + event_id % 3 AS int) END",
    "service_type_id": "CASE WHEN event_type = 'signup' THEN "
    "CASE WHEN user_id % 2 = 0 THEN '1-URGENT' ELSE '5-LOW' END END",
    "sla_committed_date": "CASE WHEN event_type = 'signup' THEN "
    "date_format(date_add(ts, cast(event_id % 3 - 1 AS int)), 'yyyy-MM-dd') END",
    "amount_vnd": "cast(round(value * 100) AS bigint)",
    "batch_no": "cast(event_id % 3 AS int)",
}


def _mapped(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    times = {"event_time", "processing_time"}
    return df.selectExpr(
        *[
            f"CAST({sql} AS timestamp) AS {name}" if name in times else f"{sql} AS {name}"
            for name, sql in columns.items()
        ]
    )


def created_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipment topic: one creation per order, some with faults."""
    return _mapped(table(spark, sf_dir, "orders"), CREATED_SQL)


def tracking_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracking topic: one scan per order line; event ids repeat."""
    return _mapped(table(spark, sf_dir, "lineitem"), TRACKING_SQL)


def financial_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Financial topic: one booking per order line; event ids repeat."""
    return _mapped(table(spark, sf_dir, "lineitem"), FINANCIAL_SQL)


def scan_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scans of one month, for the tracker and the streams."""
    return _mapped(table(spark, sf_dir, "events"), SCAN_SQL)


#: Every other delivery of the scans is a booking instead, so that each topic has rows.
BOOKED_SQL = (
    "CASE WHEN event_type = 'delivered' AND cast(substr(event_id, 2) AS bigint) % 2 = 1 "
    "THEN 'cod_collected' ELSE event_type END"
)


def scan_topics(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The scans dealt over the three topics by their type."""
    scans = scan_feed(spark, sf_dir).withColumn("event_type", F.expr(BOOKED_SQL))
    created, booked = F.col("event_type") == "shipment_created", F.col("event_type") == "cod_collected"
    goods = {"weight_gram": F.lit(None).cast("int"), "declared_value_vnd": F.lit(None).cast("bigint")}
    return {
        SHIPMENT: scans.filter(created).withColumns(goods),
        TRACKING: scans.filter(~created & ~booked),
        FINANCIAL: scans.filter(booked),
    }


TOPIC_FEEDS = {SHIPMENT: created_feed, TRACKING: tracking_feed, FINANCIAL: financial_feed}


def topic_feed(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    return TOPIC_FEEDS[topic](spark, sf_dir)


SERVICES_SQL = """SELECT * FROM VALUES
  ('1-URGENT', 'Urgent', 'EXPRESS', 1, 1, 2, 3),
  ('2-HIGH', 'High', 'SAMEDAY', 1, 1, 1, 2),
  ('3-MEDIUM', 'Medium', 'STANDARD', 2, 2, 3, 5),
  ('4-NOT SPECIFIED', 'Open', 'STANDARD', 2, 3, 4, 6),
  ('5-LOW', 'Low', 'STANDARD', 3, 4, 5, 7)
  AS s(service_type_id, service_name, speed_tier, sla_inner_city_days, sla_same_province_days,
       sla_inter_province_days, sla_remote_days)"""


DIMENSION_SQL = {
    "dim_region": ("region", ["concat('R', r_regionkey) AS region_id", "r_name AS region_name"]),
    "dim_branch": (
        "nation",
        [
            "concat('B', n_nationkey) AS branch_id",
            "n_name AS branch_name",
            "concat('R', n_regionkey) AS region_id",
        ],
    ),
    "dim_province": (
        "nation",
        [
            "concat('P', n_nationkey) AS province_id",
            "concat('R', n_regionkey) AS region_id",
            "CASE WHEN n_nationkey % 10 <> 9 THEN n_nationkey % 5 = 4 END AS is_remote",
        ],
    ),
    "dim_facility": (
        "supplier",
        [
            "concat('F', s_suppkey) AS facility_id",
            "s_name AS facility_name",
            "CASE WHEN s_suppkey % 3 = 0 THEN 'HUB' ELSE 'POST_OFFICE' END AS facility_type",
            "concat('B', s_nationkey) AS branch_id",
            "concat('P', s_nationkey) AS province_id",
            "cast(7 + s_suppkey % 4 AS int) AS capacity_per_day",
        ],
    ),
    "dim_route": (
        "supplier",
        [
            "concat('RT', s_suppkey) AS route_id",
            "concat('F', s_suppkey) AS origin_hub_id",
            "concat('F', s_suppkey + s_suppkey % 3) AS destination_hub_id",
            "cast(1 + s_suppkey % 48 AS decimal(5,2)) AS estimated_duration_hours",
        ],
    ),
    "dim_partner": (
        "customer",
        [
            "concat('C', c_custkey) AS partner_id",
            "c_name AS partner_name",
            "c_mktsegment AS partner_type",
        ],
    ),
}


class Dimensions(dict):
    """Dimension frames by name, made when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, flat: bool = False):
        super().__init__()
        self.spark, self.sf_dir, self.flat = spark, sf_dir, flat

    def __missing__(self, name: str) -> DataFrame:
        if name == "dim_service_type":
            frame = self.spark.sql(SERVICES_SQL)
        elif name == "dim_facility" and self.flat:
            frame = flat_facilities(Dimensions(self.spark, self.sf_dir))
        else:
            source, columns = DIMENSION_SQL[name]
            frame = table(self.spark, self.sf_dir, source).selectExpr(*columns)
        self[name] = frame
        return frame

    def __or__(self, other):
        out = Dimensions(self.spark, self.sf_dir, self.flat)
        out.update(self)
        out.update(other)
        return out


def dimensions(spark: SparkSession, sf_dir: str) -> Dimensions:
    """Dimension tables over supplier, nation, region and customer."""
    return Dimensions(spark, sf_dir)


def serving_dimensions(spark: SparkSession, sf_dir: str) -> Dimensions:
    """The same with the facility dimension flattened up to the region."""
    return Dimensions(spark, sf_dir, flat=True)
