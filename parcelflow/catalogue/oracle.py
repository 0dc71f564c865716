"""ANSI SQL twins of the catalogue queries, for an independent check on the same tables."""

from __future__ import annotations

WINDOW_H = 6
SLIDE_H = 2
AS_OF = "2024-01-31 00:00:00"
SPLIT = "1998-06-01 00:00:00"
SNAPSHOT = "2000-01-01 00:00:00"
STUCK_S, LOST_S, EXPRESS_S, STANDARD_S = 43_200, 129_600, 3_600, 14_400

_LINE_TIME = "l_shipdate + to_hours(l_linenumber) + to_minutes(l_partkey % 60)"
_PLACE = "facility_name, facility_type, branch_id, branch_name, region_id, region_name"

# Common table expressions, each written in terms of earlier ones.
CTES = {
    "created": """
SELECT CASE WHEN o_orderkey % 97 <> 0 THEN 'O' || o_orderkey END AS event_id,
  'shipment_created' AS event_type,
  CASE WHEN o_orderkey % 83 <> 0
       THEN o_orderdate + to_hours(o_custkey % 24) + to_minutes(o_orderkey % 60) END AS event_time,
  o_orderdate + to_hours(o_custkey % 24) + to_minutes(o_orderkey % 60)
    + to_seconds(o_custkey % 90) AS processing_time,
  'v1.0' AS schema_version,
  CASE WHEN o_orderkey % 89 <> 0 THEN 'S' || o_orderkey END AS shipment_id,
  'C' || o_custkey AS partner_id, o_orderpriority AS service_type_id,
  'P' || (o_custkey % 25) AS sender_province_id, 'D' || (o_custkey % 100) AS sender_district_id,
  'W' || (o_custkey % 500) AS sender_ward_id, 'F' || (o_custkey % 10) AS pickup_facility_id,
  'P' || (o_orderkey % 28) AS receiver_province_id,
  'D' || (o_orderkey % 100) AS receiver_district_id,
  'W' || (o_orderkey % 500) AS receiver_ward_id, 'F' || (o_orderkey % 10) AS delivery_facility_id,
  CAST(floor(o_totalprice) AS BIGINT) - 5000 AS declared_value_vnd,
  CAST(CASE WHEN o_custkey % 41 <> 40 THEN (o_custkey % 41) * 100 - 100 END AS INTEGER) AS weight_gram,
  CAST(10 + o_orderkey % 50 AS DOUBLE) AS length_cm,
  CAST(10 + o_custkey % 30 AS DOUBLE) AS width_cm,
  CAST(5 + o_orderkey % 20 AS DOUBLE) AS height_cm,
  o_orderstatus AS item_category, o_orderstatus = 'F' AS is_fragile,
  CAST(floor(o_totalprice / 2) AS BIGINT) AS cod_amount_vnd,
  CAST(floor(o_totalprice / 100) AS BIGINT) AS shipping_fee_vnd,
  CAST(floor(o_totalprice / 1000) AS BIGINT) AS fuel_surcharge_vnd,
  CAST(0 AS BIGINT) AS remote_area_fee_vnd,
  CAST(floor(o_totalprice / 500) AS BIGINT) AS insurance_fee_vnd,
  CAST(floor(o_totalprice / 50) AS BIGINT) AS total_fee_vnd,
  CASE WHEN o_orderkey % 2 = 0 THEN 'SENDER' ELSE 'RECEIVER' END AS payment_by,
  strftime(o_orderdate + to_days(CAST(o_orderkey % 9 - 1 AS INTEGER)), '%Y-%m-%d') AS sla_committed_date,
  CAST(o_custkey % 32 AS INTEGER) AS kafka_partition, o_orderkey AS kafka_offset
FROM orders""",
    "tracking": f"""
SELECT 'T' || l_orderkey || '-' || l_linenumber AS event_id,
  CASE l_returnflag || l_linestatus
    WHEN 'AF' THEN 'arrived_at_hub'
    WHEN 'AO' THEN CASE WHEN l_linenumber <= 3 THEN 'arrived_at_origin_post_office'
                        ELSE 'arrived_at_destination_post_office' END
    WHEN 'NF' THEN 'departed_hub'
    WHEN 'NO' THEN CASE WHEN l_linenumber <= 2 THEN 'departed_origin_post_office'
                        WHEN l_linenumber <= 4 THEN 'sorted_at_hub'
                        ELSE 'dispatched_for_delivery' END
    WHEN 'RF' THEN 'failed_delivery'
    ELSE CASE WHEN l_linenumber <= 5 THEN 'delivered' ELSE 'returned_to_sender' END
  END AS event_type,
  {_LINE_TIME} AS event_time, {_LINE_TIME} + to_seconds(l_partkey % 120) AS processing_time,
  'v1.0' AS schema_version, 'S' || l_orderkey AS shipment_id, 'F' || l_suppkey AS facility_id,
  CASE WHEN l_suppkey % 3 = 0 THEN 'HUB' ELSE 'POST_OFFICE' END AS facility_type,
  l_linenumber AS sequence_no,
  CASE WHEN (l_returnflag || l_linestatus) IN ('AF', 'NF') THEN 'RT' || l_suppkey END AS route_id,
  CASE WHEN l_returnflag = 'R' THEN 'H' || (l_partkey % 50) END AS shipper_id,
  CAST(CASE WHEN l_returnflag = 'R' THEN 1 + l_linenumber % 3 END AS INTEGER) AS attempt_no,
  CASE WHEN (l_returnflag || l_linestatus) = 'RF' AND l_partkey % 6 < 5
       THEN 'REASON_' || (l_partkey % 6) END AS failure_reason_code,
  CAST(NULL AS VARCHAR) AS failure_reason_detail,
  CAST(l_suppkey % 64 AS INTEGER) AS kafka_partition,
  l_partkey * 100000 + l_suppkey AS kafka_offset
FROM lineitem""",
    "financial": f"""
SELECT 'M' || l_orderkey || '-' || l_linenumber AS event_id,
  CASE WHEN l_returnflag = 'A' THEN 'shipping_fee_confirmed'
       WHEN l_returnflag = 'N' THEN 'fee_adjusted'
       WHEN l_linestatus = 'O' THEN 'cod_collected' ELSE 'cod_failed' END AS event_type,
  {_LINE_TIME} AS event_time, {_LINE_TIME} + to_seconds(l_partkey % 45) AS processing_time,
  'S' || l_orderkey AS shipment_id, 'F' || l_suppkey AS facility_id,
  'B' || (l_suppkey % 27) AS branch_id, 'C' || (l_partkey % 100) AS partner_id,
  CASE WHEN l_linenumber % 2 = 0 THEN '1-URGENT' ELSE '5-LOW' END AS service_type_id,
  CASE WHEN l_returnflag = 'A' THEN CAST(floor(l_extendedprice) AS BIGINT) END AS revenue_amount_vnd,
  CAST(CASE WHEN l_returnflag = 'R' THEN 1 + l_linenumber % 3 END AS INTEGER) AS attempt_no,
  CASE WHEN l_returnflag = 'R' THEN CAST(floor(l_extendedprice) AS BIGINT) END AS cod_amount_vnd,
  CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS BIGINT) - 25 END AS adjustment_amount_vnd,
  CAST(l_suppkey % 16 AS INTEGER) AS kafka_partition,
  l_partkey * 100000 + l_suppkey AS kafka_offset
FROM lineitem""",
    "scans": """
SELECT 'E' || event_id AS event_id,
  CASE WHEN event_type = 'signup' THEN 'shipment_created' WHEN event_type = 'error' THEN 'failed_delivery'
    WHEN event_type = 'click' AND event_id % 4 = 1 THEN 'picked_up'
    WHEN event_type = 'click' AND event_id % 4 = 2 THEN 'arrived_at_origin_post_office'
    WHEN event_type = 'click' THEN 'arrived_at_hub'
    WHEN event_type = 'view' AND event_id % 4 = 1 THEN 'departed_origin_post_office'
    WHEN event_type = 'view' AND event_id % 4 = 2 THEN 'dispatched_for_delivery'
    WHEN event_type = 'view' THEN 'departed_hub'
    WHEN event_id % 5 = 0 THEN 'returned_to_sender' ELSE 'delivered' END AS event_type,
  date_trunc('second', ts) AS event_time,
  user_id || '-' || strftime(ts, '%Y%m%d') AS shipment_id,
  CAST(event_id % 7 AS INTEGER) AS sequence_no,
  'F' || CAST(json_extract(props, '$.k') AS INTEGER) AS facility_id,
  CASE WHEN event_type = 'click' THEN 'RT' || CAST(json_extract(props, '$.k') AS INTEGER) END AS route_id,
  CASE WHEN event_type IN ('error', 'purchase') OR (event_type = 'view' AND event_id % 4 = 2)
       THEN CAST(1 + event_id % 3 AS INTEGER) END AS attempt_no,
  CASE WHEN event_type = 'signup'
       THEN CASE WHEN user_id % 2 = 0 THEN '1-URGENT' ELSE '5-LOW' END END AS service_type_id,
  CASE WHEN event_type = 'signup'
       THEN strftime(ts + to_days(CAST(event_id % 3 - 1 AS INTEGER)), '%Y-%m-%d') END AS sla_committed_date,
  CAST(round(value * 100) AS BIGINT) AS amount_vnd
FROM events""",
    "dim_region": "SELECT 'R' || r_regionkey AS region_id, r_name AS region_name FROM region",
    "dim_branch": "SELECT 'B' || n_nationkey AS branch_id, n_name AS branch_name, "
    "'R' || n_regionkey AS region_id FROM nation",
    "dim_province": "SELECT 'P' || n_nationkey AS province_id, 'R' || n_regionkey AS region_id, "
    "CASE WHEN n_nationkey % 10 <> 9 THEN n_nationkey % 5 = 4 END AS is_remote FROM nation",
    "dim_facility": """
SELECT 'F' || s_suppkey AS facility_id, s_name AS facility_name,
  CASE WHEN s_suppkey % 3 = 0 THEN 'HUB' ELSE 'POST_OFFICE' END AS facility_type,
  'B' || s_nationkey AS branch_id, coalesce(n_name, 'UNKNOWN') AS branch_name,
  coalesce('R' || n_regionkey, 'UNKNOWN') AS region_id, coalesce(r_name, 'UNKNOWN') AS region_name,
  'P' || s_nationkey AS province_id, CAST(7 + s_suppkey % 4 AS INTEGER) AS capacity_per_day
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey""",
    "dim_route": "SELECT 'RT' || s_suppkey AS route_id, 'F' || s_suppkey AS origin_hub_id, "
    "'F' || (s_suppkey + s_suppkey % 3) AS destination_hub_id, "
    "CAST(1 + s_suppkey % 48 AS DOUBLE) AS estimated_duration_hours FROM supplier",
    "dim_partner": "SELECT 'C' || c_custkey AS partner_id, c_name AS partner_name, "
    "c_mktsegment AS partner_type FROM customer",
    "dim_service": """
SELECT * FROM (VALUES ('1-URGENT', 'Urgent', 'EXPRESS'), ('2-HIGH', 'High', 'SAMEDAY'),
  ('3-MEDIUM', 'Medium', 'STANDARD'), ('4-NOT SPECIFIED', 'Open', 'STANDARD'),
  ('5-LOW', 'Low', 'STANDARD')) AS s(service_type_id, service_name, speed_tier)""",
    # Quality
    "flagged": """
SELECT *, (event_id IS NULL) AS f1, (event_time IS NULL) AS f2, (shipment_id IS NULL) AS f3,
  coalesce(weight_gram <= 0, false) AS f4, coalesce(declared_value_vnd < 0, false) AS f5,
  coalesce(CAST(sla_committed_date AS DATE) < CAST(event_time AS DATE), false) AS f6
FROM created""",
    "valid_created": "SELECT * FROM flagged WHERE NOT (f1 OR f2 OR f3 OR f4 OR f5 OR f6)",
    # KPI tables; `w` is the window start
    "k_volume": f"""
SELECT time_bucket(INTERVAL '{WINDOW_H} hours', event_time, TIMESTAMP '1970-01-01') AS window_start,
  pickup_facility_id, count(*) AS order_count, max(processing_time) AS ingested_at
FROM valid_created GROUP BY ALL""",
    "k_partner": f"""
SELECT time_bucket(INTERVAL '{WINDOW_H} hours', event_time, TIMESTAMP '1970-01-01') AS window_start,
  partner_id, service_type_id, count(*) AS order_count, max(processing_time) AS ingested_at
FROM valid_created GROUP BY ALL""",
    "k_flow": f"""
SELECT time_bucket(INTERVAL '{WINDOW_H} hours', event_time, TIMESTAMP '1970-01-01') AS window_start,
  facility_id,
  count(*) FILTER (event_type LIKE 'arrived%') AS inbound_count,
  count(*) FILTER (event_type IN ('departed_origin_post_office', 'departed_hub',
                                  'dispatched_for_delivery')) AS outbound_count,
  count(*) FILTER (event_type = 'failed_delivery') AS failed_delivery_count,
  count(*) FILTER (event_type = 'dispatched_for_delivery') AS out_for_delivery_count,
  max(processing_time) AS ingested_at
FROM tracking GROUP BY 1, 2""",
    "k_reason": f"""
SELECT time_bucket(INTERVAL '{WINDOW_H} hours', event_time, TIMESTAMP '1970-01-01') AS window_start,
  coalesce(failure_reason_code, 'UNKNOWN') AS failure_reason_code,
  count(*) AS failed_delivery_count, max(processing_time) AS ingested_at
FROM tracking WHERE event_type = 'failed_delivery' GROUP BY 1, 2""",
    "k_returns": f"""
SELECT time_bucket(INTERVAL '{WINDOW_H} hours', event_time, TIMESTAMP '1970-01-01') AS window_start,
  count(*) FILTER (event_type = 'returned_to_sender') AS returned_count,
  max(processing_time) AS ingested_at
FROM tracking GROUP BY 1""",
    "k_financial": f"""
SELECT time_bucket(INTERVAL '{SLIDE_H} hours', event_time, TIMESTAMP '1970-01-01')
    - to_hours(back) AS window_start,
  facility_id,
  CAST(sum(coalesce(revenue_amount_vnd, 0) + coalesce(adjustment_amount_vnd, 0)) AS BIGINT) AS total_revenue_vnd,
  CAST(sum(CASE WHEN event_type = 'cod_collected' THEN cod_amount_vnd ELSE 0 END) AS BIGINT) AS total_cod_vnd,
  count(*) FILTER (event_type = 'cod_collected') AS cod_collected_count,
  count(*) FILTER (event_type IN ('cod_collected', 'cod_failed')) AS cod_committed_count,
  max(processing_time) AS ingested_at
FROM financial CROSS JOIN (SELECT unnest([0, {SLIDE_H}, {2 * SLIDE_H}]) AS back) GROUP BY 1, 2""",
    # Views that others read
    "v_flow": f"""
SELECT window_start, window_start + INTERVAL '{WINDOW_H} hours' AS window_end, k.facility_id,
  {_PLACE}, inbound_count + outbound_count AS facility_throughput,
  inbound_count - outbound_count AS facility_backlog, failed_delivery_count, out_for_delivery_count,
  coalesce(failed_delivery_count / nullif(out_for_delivery_count, 0), 0.0) AS failed_delivery_rate,
  coalesce((inbound_count - outbound_count) / nullif(capacity_per_day, 0), 0.0) * 100 AS capacity_utilization_pct,
  capacity_per_day
FROM k_flow AS k LEFT JOIN dim_facility AS d ON k.facility_id = d.facility_id""",
    # Cleaned events
    "clean_created": """
SELECT * FROM valid_created
QUALIFY row_number() OVER (PARTITION BY event_type, event_id
                           ORDER BY event_time, kafka_partition, kafka_offset) = 1""",
    "clean_tracking": """
SELECT *, upper(event_type) AS event_type_norm FROM tracking
QUALIFY row_number() OVER (PARTITION BY event_type, event_id
                           ORDER BY event_time, kafka_partition, kafka_offset) = 1""",
    "clean_financial": """
SELECT * FROM financial
QUALIFY row_number() OVER (PARTITION BY event_type, event_id
                           ORDER BY event_time, kafka_partition, kafka_offset) = 1""",
    # Facts
    "moves": """
SELECT event_id, shipment_id, 'ORDER_CREATED' AS norm, event_time, pickup_facility_id AS place,
  CAST(NULL AS VARCHAR) AS route_id, CAST(NULL AS VARCHAR) AS carrier,
  CAST(NULL AS INTEGER) AS sequence_no, kafka_partition, kafka_offset FROM clean_created
UNION ALL
SELECT event_id, shipment_id, event_type_norm, event_time, facility_id, route_id, shipper_id,
  sequence_no, kafka_partition, kafka_offset FROM clean_tracking""",
    "status_map": """
SELECT * FROM (VALUES ('ORDER_CREATED', 'CREATED'), ('PICKUP_ASSIGNED', 'PICKUP_ASSIGNED'),
  ('PICKED_UP', 'PICKED_UP'), ('ARRIVED_AT_ORIGIN_POST_OFFICE', 'AT_ORIGIN_POST_OFFICE'),
  ('DEPARTED_ORIGIN_POST_OFFICE', 'AT_ORIGIN_POST_OFFICE'), ('ARRIVED_AT_HUB', 'IN_TRANSIT'),
  ('SORTED_AT_HUB', 'IN_TRANSIT'), ('DEPARTED_HUB', 'IN_TRANSIT'),
  ('ARRIVED_AT_DESTINATION_POST_OFFICE', 'AT_DESTINATION_POST_OFFICE'),
  ('DISPATCHED_FOR_DELIVERY', 'OUT_FOR_DELIVERY'), ('DELIVERED', 'DELIVERED'),
  ('FAILED_DELIVERY', 'FAILED_DELIVERY'), ('RETURN_INITIATED', 'RETURNING'),
  ('RETURNED_TO_SENDER', 'RETURNED')) AS m(norm, status)""",
}


def _fact_shipment(where: str) -> str:
    """Shipment fact of one window of events."""
    static = (
        "partner_id, service_type_id, sender_province_id, sender_district_id, sender_ward_id, "
        "pickup_facility_id, receiver_province_id, receiver_district_id, receiver_ward_id, "
        "delivery_facility_id, declared_value_vnd, weight_gram, length_cm, width_cm, height_cm, "
        "item_category, is_fragile, cod_amount_vnd, shipping_fee_vnd, fuel_surcharge_vnd, "
        "remote_area_fee_vnd, insurance_fee_vnd, total_fee_vnd, sla_committed_date"
    )
    return f"""
SELECT a.shipment_id, {static}, status AS current_status, current_facility_id, assigned_shipper_id,
  CAST(strftime(created_at, '%Y%m%d') AS INTEGER) AS created_date_id,
  CAST(strftime(delivered_at, '%Y%m%d') AS INTEGER) AS delivered_date_id,
  CAST(strftime(returned_at, '%Y%m%d') AS INTEGER) AS returned_date_id,
  created_at, origin_post_office_arrived_at, origin_post_office_departed_at, first_hub_arrived_at,
  last_hub_departed_at, dispatched_for_delivery_at, delivered_at, returned_at, updated_at,
  coalesce(CAST(sla_committed_date AS DATE) < CAST(delivered_at AS DATE), false) AS is_delayed,
  returned_at IS NOT NULL AS is_returned, false AS is_lost
FROM (
  SELECT shipment_id,
    min(event_time) FILTER (norm = 'ORDER_CREATED') AS created_at,
    max(event_time) FILTER (norm = 'ARRIVED_AT_ORIGIN_POST_OFFICE') AS origin_post_office_arrived_at,
    max(event_time) FILTER (norm = 'DEPARTED_ORIGIN_POST_OFFICE') AS origin_post_office_departed_at,
    min(event_time) FILTER (norm = 'ARRIVED_AT_HUB') AS first_hub_arrived_at,
    max(event_time) FILTER (norm = 'DEPARTED_HUB') AS last_hub_departed_at,
    max(event_time) FILTER (norm = 'DISPATCHED_FOR_DELIVERY') AS dispatched_for_delivery_at,
    max(event_time) FILTER (norm = 'DELIVERED') AS delivered_at,
    max(event_time) FILTER (norm = 'RETURNED_TO_SENDER') AS returned_at,
    max(carrier) AS assigned_shipper_id
  FROM moves WHERE {where} GROUP BY 1) AS a
JOIN (
  SELECT shipment_id, norm AS last_norm, place AS current_facility_id, event_time AS updated_at
  FROM moves WHERE {where}
  QUALIFY row_number() OVER (PARTITION BY shipment_id
    ORDER BY event_time DESC, norm DESC, place DESC NULLS LAST) = 1) AS l
  ON a.shipment_id = l.shipment_id
LEFT JOIN status_map ON last_norm = status_map.norm
LEFT JOIN (
  SELECT shipment_id, {static} FROM clean_created WHERE {where}
  QUALIFY row_number() OVER (PARTITION BY shipment_id
                             ORDER BY event_time, kafka_partition, kafka_offset) = 1) AS c
  ON a.shipment_id = c.shipment_id"""


CTES |= {
    "fact_shipment": _fact_shipment("true"),
    "fact_before": _fact_shipment(f"event_time < TIMESTAMP '{SPLIT}'"),
    "fact_after": _fact_shipment(f"event_time >= TIMESTAMP '{SPLIT}'"),
    "fact_route": """
SELECT event_id, shipment_id, CAST(strftime(event_time, '%Y%m%d') AS INTEGER) AS date_id,
  place AS facility_id, route_id, carrier AS shipper_id, sequence_no, norm AS event_type, event_time
FROM moves
QUALIFY row_number() OVER (PARTITION BY event_id
                           ORDER BY event_time, kafka_partition, kafka_offset) = 1""",
    "fact_attempt": """
SELECT a.shipment_id, a.attempt_no, shipper_id, facility_id,
  CAST(strftime(event_time, '%Y%m%d') AS INTEGER) AS date_id, event_time AS attempt_ts,
  CASE WHEN event_type = 'delivered' THEN 'SUCCESS' ELSE 'FAILED' END AS result,
  failure_reason_code, failure_reason_detail, coalesce(cod, 0) AS cod_collected_vnd
FROM (
  SELECT * FROM clean_tracking WHERE event_type IN ('delivered', 'failed_delivery')
  QUALIFY row_number() OVER (PARTITION BY shipment_id, attempt_no
                             ORDER BY event_time, kafka_partition, kafka_offset) = 1) AS a
LEFT JOIN (
  SELECT shipment_id, attempt_no, cod_amount_vnd AS cod FROM clean_financial
  WHERE event_type = 'cod_collected'
  QUALIFY row_number() OVER (PARTITION BY shipment_id, attempt_no
                             ORDER BY event_time, kafka_partition, kafka_offset) = 1) AS c
  ON a.shipment_id = c.shipment_id AND a.attempt_no = c.attempt_no""",
    "fact_financial": """
SELECT event_id, shipment_id, event_time AS transaction_ts, facility_id, branch_id, partner_id,
  service_type_id,
  CASE event_type WHEN 'shipping_fee_confirmed' THEN 'SHIPPING_FEE'
    WHEN 'cod_collected' THEN 'COD_COLLECTION' WHEN 'cod_failed' THEN 'COD_FAILED'
    ELSE 'FEE_ADJUSTMENT' END AS revenue_type,
  CASE event_type WHEN 'shipping_fee_confirmed' THEN revenue_amount_vnd
    WHEN 'fee_adjusted' THEN adjustment_amount_vnd ELSE 0 END AS revenue_amount_vnd,
  CASE WHEN event_type = 'cod_collected' THEN cod_amount_vnd ELSE 0 END AS cod_amount_vnd,
  CASE WHEN event_type = 'cod_collected' THEN event_time END AS collected_at
FROM clean_financial
QUALIFY row_number() OVER (PARTITION BY event_id
                           ORDER BY event_time, kafka_partition, kafka_offset) = 1""",
    "presence": """
SELECT facility_id, shipment_id,
  sum(CASE WHEN event_type LIKE 'arrived%' THEN 1 ELSE -1 END) AS net,
  max(event_time) FILTER (event_type LIKE 'arrived%') AS arrived_at
FROM clean_tracking
WHERE (event_type LIKE 'arrived%' OR event_type IN ('departed_origin_post_office', 'departed_hub',
       'dispatched_for_delivery')) AND event_time < TIMESTAMP '2000-01-01 00:00:00'
GROUP BY 1, 2""",
    # Journeys
    "scan_events": """
SELECT e.*, r.destination_hub_id AS route_hub_id, s.speed_tier AS tier
FROM scans AS e LEFT JOIN dim_route AS r ON e.route_id = r.route_id
LEFT JOIN dim_service AS s ON e.service_type_id = s.service_type_id""",
    "hub_steps": """
SELECT * FROM (
  SELECT *, lag(event_type) OVER h AS before_type, lag(event_time) OVER h AS before_at,
    lag(facility_id) OVER h AS before_hub
  FROM (
    SELECT *, last_value(CASE WHEN event_type = 'shipment_created' THEN coalesce(tier, 'STANDARD') END
        IGNORE NULLS) OVER (PARTITION BY shipment_id ORDER BY event_time, sequence_no, event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS known_tier
    FROM scan_events WHERE event_type IN ('arrived_at_hub', 'departed_hub', 'shipment_created')) AS x
  WHERE event_type <> 'shipment_created'
  WINDOW h AS (PARTITION BY shipment_id ORDER BY event_time, sequence_no, event_id)) AS y""",
    "dwells": """
SELECT shipment_id, before_hub AS hub_id, before_at AS arrived_at, event_time AS departed_at,
  epoch_ms(event_time) - epoch_ms(before_at) AS dwell_ms, known_tier
FROM hub_steps WHERE event_type = 'departed_hub' AND before_type = 'arrived_at_hub'""",
    "progress": """
SELECT p.*, coalesce(d.dwell_ms, 0) AS dwell_ms FROM (
  SELECT shipment_id,
    min(event_time) FILTER (event_type = 'shipment_created') AS created_at,
    last(sla_committed_date ORDER BY event_time, sequence_no, event_id)
      FILTER (event_type = 'shipment_created') AS sla,
    max(event_time) AS last_at,
    last(event_type ORDER BY event_time, sequence_no, event_id) AS last_type,
    last(facility_id ORDER BY event_time, sequence_no, event_id) AS place,
    max(event_time) FILTER (event_type = 'picked_up') AS picked_up_at,
    max(event_time) FILTER (event_type = 'arrived_at_origin_post_office') AS origin_in_at,
    max(event_time) FILTER (event_type = 'departed_origin_post_office') AS origin_out_at,
    max(event_time) FILTER (event_type = 'dispatched_for_delivery') AS dispatched_at,
    max(attempt_no) FILTER (event_type IN ('dispatched_for_delivery', 'delivered', 'failed_delivery')) AS attempt,
    last(event_type ORDER BY event_time, sequence_no, event_id)
      FILTER (event_type IN ('delivered', 'returned_to_sender')) = 'delivered' AS arrived,
    last(event_time ORDER BY event_time, sequence_no, event_id)
      FILTER (event_type IN ('delivered', 'returned_to_sender')) AS done_at
  FROM scan_events GROUP BY 1) AS p
LEFT JOIN (SELECT shipment_id, CAST(sum(dwell_ms) AS BIGINT) AS dwell_ms FROM dwells GROUP BY 1) AS d
  ON p.shipment_id = d.shipment_id""",
    "journeys": f"""
SELECT shipment_id,
  CASE WHEN arrived THEN 'DELIVERED' WHEN done_at IS NOT NULL THEN 'RETURNED'
    WHEN epoch_ms(TIMESTAMP '{AS_OF}') - epoch_ms(last_at) > {LOST_S}000 THEN 'LOST'
    WHEN epoch_ms(TIMESTAMP '{AS_OF}') - epoch_ms(last_at) > {STUCK_S}000 THEN 'STUCK'
    ELSE 'IN_PROCESS' END AS status,
  place AS current_facility,
  CAST((epoch_ms(done_at) - epoch_ms(created_at)) / 1000.0 AS DOUBLE) AS e2e_transit_s,
  CASE WHEN done_at IS NOT NULL
       THEN CAST((epoch_ms(picked_up_at) - epoch_ms(created_at)) / 1000.0 AS DOUBLE) END AS pickup_lead_s,
  CASE WHEN done_at IS NOT NULL
       THEN CAST((epoch_ms(origin_in_at) - epoch_ms(picked_up_at)) / 1000.0 AS DOUBLE) END AS first_mile_s,
  CASE WHEN done_at IS NOT NULL
       THEN CAST((epoch_ms(origin_out_at) - epoch_ms(origin_in_at)) / 1000.0 AS DOUBLE) END AS origin_po_dwell_s,
  CASE WHEN done_at IS NOT NULL THEN CAST(dwell_ms / 1000.0 AS DOUBLE) END AS total_hub_dwell_s,
  CASE WHEN arrived THEN CAST((epoch_ms(done_at) - epoch_ms(dispatched_at)) / 1000.0 AS DOUBLE) END AS last_mile_s,
  CASE WHEN done_at IS NOT NULL THEN sla END AS sla_committed_date,
  CASE WHEN arrived THEN strftime(done_at, '%Y-%m-%d') END AS delivered_date,
  CASE WHEN done_at IS NOT NULL
       THEN CAST(coalesce(arrived AND strftime(done_at, '%Y-%m-%d') <= sla, false) AS INTEGER) END AS sla_met,
  CASE WHEN done_at IS NOT NULL
       THEN CAST(coalesce(strftime(done_at, '%Y-%m-%d') > sla, false) AS INTEGER) END AS sla_breach,
  CASE WHEN done_at IS NOT NULL THEN attempt END AS attempt_count,
  CASE WHEN done_at IS NOT NULL THEN CAST(arrived AND coalesce(attempt, 1) = 1 AS INTEGER) END AS first_attempt_success,
  CASE WHEN done_at IS NOT NULL THEN CAST(coalesce(attempt, 1) > 1 AS INTEGER) END AS is_redelivery,
  CASE WHEN done_at IS NOT NULL THEN done_at
    WHEN epoch_ms(TIMESTAMP '{AS_OF}') - epoch_ms(last_at) > {LOST_S}000 THEN last_at + to_seconds({LOST_S})
    WHEN epoch_ms(TIMESTAMP '{AS_OF}') - epoch_ms(last_at) > {STUCK_S}000 THEN last_at + to_seconds({STUCK_S})
    ELSE last_at END AS updated_at
FROM progress""",
    "alerts": f"""
SELECT event_time AS detected_at, shipment_id, facility_id, 'ABNORMAL_ROUTE' AS anomaly_type,
  'WARNING' AS severity,
  'arrived ' || facility_id || ', route ' || route_id || ' expects ' || route_hub_id AS detail
FROM scan_events WHERE event_type = 'arrived_at_hub' AND route_hub_id <> facility_id
UNION ALL
SELECT departed_at, shipment_id, hub_id, 'LONG_HUB_DWELL', 'WARNING',
  'dwell ' || CAST(round_even(dwell_ms / 1000.0, 0) AS BIGINT) || 's > '
  || CASE WHEN known_tier IN ('EXPRESS', 'SAMEDAY') THEN {EXPRESS_S} ELSE {STANDARD_S} END
  || 's (' || coalesce(known_tier, 'None') || ')'
FROM dwells
WHERE dwell_ms > CASE WHEN known_tier IN ('EXPRESS', 'SAMEDAY') THEN {EXPRESS_S} ELSE {STANDARD_S} END * 1000
UNION ALL
SELECT event_time, shipment_id, facility_id, 'MULTIPLE_FAILURES', 'WARNING', '2nd failed_delivery'
FROM (SELECT * FROM scan_events WHERE event_type = 'failed_delivery'
      QUALIFY row_number() OVER (PARTITION BY shipment_id
                                 ORDER BY event_time, sequence_no, event_id) = 2) AS f
UNION ALL
SELECT last_at + to_seconds({STUCK_S}), shipment_id, place, 'STUCK_SHIPMENT', 'WARNING',
  'no event for >{STUCK_S}s; last=' || last_type
FROM progress WHERE done_at IS NULL
  AND epoch_ms(TIMESTAMP '{AS_OF}') - epoch_ms(last_at) > {STUCK_S}000
UNION ALL
SELECT last_at + to_seconds({LOST_S}), shipment_id, place, 'SUSPECTED_LOST', 'CRITICAL',
  'no event for >{LOST_S}s; last=' || last_type
FROM progress WHERE done_at IS NULL
  AND epoch_ms(TIMESTAMP '{AS_OF}') - epoch_ms(last_at) > {LOST_S}000""",
    # Three topics, tracking a step behind: what the batches bring
    "dealt": """
SELECT * REPLACE (CASE WHEN event_type = 'delivered' AND CAST(substr(event_id, 2) AS BIGINT) % 2 = 1
                       THEN 'cod_collected' ELSE event_type END AS event_type) FROM scans""",
    "arrivals": """
SELECT *, (date_diff('day', low, event_time) // ((date_diff('day', low, high) + 3) // 3))
    + CASE WHEN topic = 'tracking' THEN 1 ELSE 0 END AS batch
FROM (SELECT *, CASE event_type WHEN 'shipment_created' THEN 'shipment' WHEN 'cod_collected' THEN 'financial'
          ELSE 'tracking' END AS topic FROM dealt) AS d,
  (SELECT min(event_time) AS low, max(event_time) AS high FROM scans) AS span
WHERE event_type <> 'shipment_created' OR sla_committed_date >= strftime(event_time, '%Y-%m-%d')""",
    "marks_union": """
SELECT batch, max(newest) OVER (ORDER BY batch) - INTERVAL '60 seconds' AS mark
FROM (SELECT batch, max(event_time) AS newest FROM arrivals GROUP BY 1) AS b""",
    "marks_topics": """
SELECT batch, max(CASE WHEN topics = 3 THEN slowest END) OVER (ORDER BY batch) - INTERVAL '60 seconds' AS mark
FROM (SELECT batch, count(*) AS topics, min(newest) AS slowest
      FROM (SELECT batch, topic, max(event_time) AS newest FROM arrivals GROUP BY 1, 2) AS t GROUP BY 1) AS b""",
    "journey_latency": """
SELECT shipment_id, status, updated_at, updated_at + to_seconds(length(shipment_id) * 3) AS ingested_at,
  CAST(length(shipment_id) * 3 AS BIGINT) AS pipeline_latency_s
FROM journeys WHERE status IN ('IN_PROCESS', 'DELIVERED', 'RETURNED')""",
}



def tracked_topics(marks: str) -> str:
    """Last journey row per shipment of a tracker whose watermark after each batch is in ``marks``."""
    order = "ORDER BY batch, event_time, sequence_no, event_id"
    done = "done_at IS NOT NULL"
    return f"""
WITH kept AS (
  SELECT a.* FROM arrivals AS a LEFT JOIN {marks} AS m ON m.batch = a.batch - 1
  WHERE m.mark IS NULL OR a.event_time > m.mark),
stays AS (
  SELECT shipment_id, CAST(sum(epoch_ms(event_time) - epoch_ms(before_at)) AS BIGINT) AS dwell_ms
  FROM (SELECT *, lag(event_type) OVER h AS before_type, lag(event_time) OVER h AS before_at
        FROM kept WHERE event_type IN ('arrived_at_hub', 'departed_hub')
        WINDOW h AS (PARTITION BY shipment_id {order})) AS x
  WHERE event_type = 'departed_hub' AND before_type = 'arrived_at_hub' GROUP BY 1),
folded AS (
  SELECT shipment_id, min(event_time) FILTER (event_type = 'shipment_created') AS created_at,
    last(sla_committed_date {order}) FILTER (event_type = 'shipment_created') AS sla,
    max(event_time) AS last_at, last(facility_id {order}) AS place,
    max(event_time) FILTER (event_type = 'picked_up') AS picked_up_at,
    max(event_time) FILTER (event_type = 'dispatched_for_delivery') AS dispatched_at,
    max(attempt_no) FILTER (event_type IN ('dispatched_for_delivery', 'delivered', 'failed_delivery')) AS attempt,
    last(event_type {order}) FILTER (event_type IN ('delivered', 'returned_to_sender')) = 'delivered' AS arrived,
    last(event_time {order}) FILTER (event_type IN ('delivered', 'returned_to_sender')) AS done_at
  FROM kept GROUP BY 1),
clocked AS (
  SELECT f.*, coalesce(s.dwell_ms, 0) AS dwell_ms,
    (SELECT count(DISTINCT mark) FROM {marks} WHERE mark > f.last_at + to_seconds({STUCK_S})) AS passed,
    (SELECT count(*) FROM {marks} WHERE mark > f.last_at + to_seconds({LOST_S})) AS passed_lost
  FROM folded AS f LEFT JOIN stays AS s ON f.shipment_id = s.shipment_id),
named AS (
  SELECT *, CASE WHEN arrived THEN 'DELIVERED' WHEN {done} THEN 'RETURNED' WHEN passed > 1 AND passed_lost > 0 THEN 'LOST'
    WHEN passed > 0 THEN 'STUCK' ELSE 'IN_PROCESS' END AS status FROM clocked)
SELECT shipment_id, status, coalesce(place, 'UNKNOWN') AS current_facility,
  CAST((epoch_ms(done_at) - epoch_ms(created_at)) / 1000.0 AS DOUBLE) AS e2e_transit_s,
  CASE WHEN {done} THEN CAST((epoch_ms(picked_up_at) - epoch_ms(created_at)) / 1000.0 AS DOUBLE) END AS pickup_lead_s,
  CASE WHEN {done} THEN CAST(dwell_ms / 1000.0 AS DOUBLE) END AS total_hub_dwell_s,
  CASE WHEN arrived THEN CAST((epoch_ms(done_at) - epoch_ms(dispatched_at)) / 1000.0 AS DOUBLE) END AS last_mile_s,
  coalesce(CASE WHEN {done} THEN sla END, 'UNKNOWN') AS sla_committed_date,
  CASE WHEN {done} THEN CAST(coalesce(arrived AND strftime(done_at, '%Y-%m-%d') <= sla, false) AS INTEGER) END AS sla_met,
  CASE WHEN {done} THEN attempt END AS attempt_count,
  CASE status WHEN 'DELIVERED' THEN done_at WHEN 'RETURNED' THEN done_at WHEN 'LOST' THEN last_at + to_seconds({LOST_S})
    WHEN 'STUCK' THEN last_at + to_seconds({STUCK_S}) ELSE last_at END AS updated_at
FROM named"""


def _uses(text: str) -> list[str]:
    """CTEs a statement names, in definition order."""
    words = set("".join(c if c.isalnum() or c == "_" else " " for c in text).split())
    return [name for name in CTES if name in words]


def query(select: str) -> str:
    """Statement with the CTEs it needs in front."""
    needed: set[str] = set()
    todo = _uses(select)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo.extend(n for n in _uses(CTES[name]) if n != name)
    order = [name for name in CTES if name in needed]
    if not order:
        return select
    shared = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in order)
    if select.lstrip().startswith("WITH "):
        return f"WITH {shared},\n{select.lstrip().removeprefix('WITH ')}"
    return f"WITH {shared}\n{select}"
