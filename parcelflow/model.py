"""Event, fact and dimension shapes. The names and types below are fixed values."""

from __future__ import annotations

import re

from pyspark.sql import types as T

SHIPMENT = "logistics.shipment.events"
TRACKING = "logistics.tracking.events"
FINANCIAL = "logistics.financial.events"
TOPICS = (SHIPMENT, TRACKING, FINANCIAL)

ENVELOPE = (
    "event_id string, event_type string, event_time timestamp, "
    "processing_time timestamp, schema_version string, shipment_id string"
)

# Payload of each topic, the union over its event types.
PAYLOAD = {
    SHIPMENT: (
        "partner_id string, service_type_id string, "
        "sender_province_id string, sender_district_id string, sender_ward_id string, "
        "pickup_facility_id string, "
        "receiver_province_id string, receiver_district_id string, receiver_ward_id string, "
        "delivery_facility_id string, "
        "declared_value_vnd bigint, weight_gram int, "
        "length_cm double, width_cm double, height_cm double, "
        "item_category string, is_fragile boolean, "
        "cod_amount_vnd bigint, shipping_fee_vnd bigint, fuel_surcharge_vnd bigint, "
        "remote_area_fee_vnd bigint, insurance_fee_vnd bigint, total_fee_vnd bigint, "
        "payment_by string, sla_committed_date string, "
        "assigned_shipper_id string, shipper_id string, reweighed_gram int, "
        "facility_id string, reason_code string"
    ),
    TRACKING: (
        "facility_id string, facility_type string, sequence_no int, route_id string, "
        "destination_facility_id string, shipper_id string, attempt_no int, "
        "recipient_relation string, failure_reason_code string, failure_reason_detail string"
    ),
    FINANCIAL: (
        "facility_id string, branch_id string, partner_id string, service_type_id string, "
        "revenue_type string, revenue_amount_vnd bigint, shipping_fee_vnd bigint, "
        "fuel_surcharge_vnd bigint, remote_area_fee_vnd bigint, insurance_fee_vnd bigint, "
        "shipper_id string, attempt_no int, cod_amount_vnd bigint, reason_code string, "
        "old_total_fee_vnd bigint, new_total_fee_vnd bigint, adjustment_amount_vnd bigint"
    ),
}

# Columns every event type of a topic carries.
SHARED_COLUMNS = {
    SHIPMENT: "",
    TRACKING: "facility_id facility_type sequence_no",
    FINANCIAL: "facility_id branch_id partner_id service_type_id",
}

# Event types by topic, with the columns only that type carries.
EVENT_COLUMNS = {
    SHIPMENT: {
        "shipment_created": (
            "partner_id service_type_id sender_province_id sender_district_id sender_ward_id "
            "pickup_facility_id receiver_province_id receiver_district_id receiver_ward_id "
            "delivery_facility_id declared_value_vnd weight_gram length_cm width_cm height_cm "
            "item_category is_fragile cod_amount_vnd shipping_fee_vnd fuel_surcharge_vnd "
            "remote_area_fee_vnd insurance_fee_vnd total_fee_vnd payment_by sla_committed_date"
        ),
        "pickup_assigned": "pickup_facility_id assigned_shipper_id",
        "picked_up": "pickup_facility_id shipper_id reweighed_gram",
        "return_initiated": "facility_id reason_code",
    },
    TRACKING: {
        "arrived_at_origin_post_office": "",
        "departed_origin_post_office": "route_id",
        "arrived_at_hub": "route_id",
        "sorted_at_hub": "",
        "departed_hub": "route_id destination_facility_id",
        "arrived_at_destination_post_office": "",
        "dispatched_for_delivery": "shipper_id attempt_no",
        "delivered": "shipper_id attempt_no recipient_relation",
        "failed_delivery": "shipper_id attempt_no failure_reason_code failure_reason_detail",
        "returned_to_sender": "",
    },
    FINANCIAL: {
        "shipping_fee_confirmed": (
            "revenue_type revenue_amount_vnd shipping_fee_vnd fuel_surcharge_vnd "
            "remote_area_fee_vnd insurance_fee_vnd"
        ),
        "cod_collected": "shipper_id attempt_no cod_amount_vnd",
        "cod_failed": "shipper_id attempt_no cod_amount_vnd reason_code",
        "fee_adjusted": "old_total_fee_vnd new_total_fee_vnd adjustment_amount_vnd reason_code",
    },
}

TRANSPORT = "kafka_partition int, kafka_offset bigint, ingest_time timestamp"

ARRIVALS = ("arrived_at_origin_post_office", "arrived_at_hub", "arrived_at_destination_post_office")
DEPARTURES = ("departed_origin_post_office", "departed_hub", "dispatched_for_delivery")
TERMINAL = ("delivered", "returned_to_sender")
EXPRESS_TIERS = ("EXPRESS", "SAMEDAY")

# Normalised event type -> shipment status.
STATUS_OF = {
    "ORDER_CREATED": "CREATED",
    "PICKUP_ASSIGNED": "PICKUP_ASSIGNED",
    "PICKED_UP": "PICKED_UP",
    "ARRIVED_AT_ORIGIN_POST_OFFICE": "AT_ORIGIN_POST_OFFICE",
    "DEPARTED_ORIGIN_POST_OFFICE": "AT_ORIGIN_POST_OFFICE",
    "ARRIVED_AT_HUB": "IN_TRANSIT",
    "SORTED_AT_HUB": "IN_TRANSIT",
    "DEPARTED_HUB": "IN_TRANSIT",
    "ARRIVED_AT_DESTINATION_POST_OFFICE": "AT_DESTINATION_POST_OFFICE",
    "DISPATCHED_FOR_DELIVERY": "OUT_FOR_DELIVERY",
    "DELIVERED": "DELIVERED",
    "FAILED_DELIVERY": "FAILED_DELIVERY",
    "RETURN_INITIATED": "RETURNING",
    "RETURNED_TO_SENDER": "RETURNED",
}

# Fact tables.
FACT_SHIPMENT = (
    "shipment_id string, partner_id string, service_type_id string, "
    "sender_province_id string, sender_district_id string, sender_ward_id string, "
    "pickup_facility_id string, "
    "receiver_province_id string, receiver_district_id string, receiver_ward_id string, "
    "delivery_facility_id string, "
    "declared_value_vnd decimal(20,6), weight_gram int, "
    "length_cm double, width_cm double, height_cm double, "
    "item_category string, is_fragile boolean, "
    "cod_amount_vnd decimal(20,6), shipping_fee_vnd decimal(20,6), "
    "fuel_surcharge_vnd decimal(20,6), remote_area_fee_vnd decimal(20,6), "
    "insurance_fee_vnd decimal(20,6), total_fee_vnd decimal(20,6), "
    "sla_committed_date string, current_status string, current_facility_id string, "
    "assigned_shipper_id string, "
    "created_date_id int, delivered_date_id int, returned_date_id int, "
    "created_at timestamp, pickedup_at timestamp, "
    "origin_post_office_arrived_at timestamp, origin_post_office_departed_at timestamp, "
    "first_hub_arrived_at timestamp, last_hub_departed_at timestamp, "
    "dispatched_for_delivery_at timestamp, delivered_at timestamp, returned_at timestamp, "
    "updated_at timestamp, is_delayed boolean, is_returned boolean, is_lost boolean"
)
FACT_ROUTE = (
    "event_id string, shipment_id string, date_id int, facility_id string, route_id string, "
    "shipper_id string, sequence_no int, event_type string, event_time timestamp"
)
FACT_ATTEMPT = (
    "shipment_id string, attempt_no int, shipper_id string, facility_id string, date_id int, "
    "attempt_ts timestamp, result string, failure_reason_code string, "
    "failure_reason_detail string, cod_collected_vnd bigint"
)
FACT_INVENTORY = (
    "date_id int, snapshot_ts timestamp, facility_id string, total_shipments int, "
    "capacity_utilization_pct decimal(5,2)"
)
FACT_FINANCIAL = (
    "event_id string, shipment_id string, transaction_ts timestamp, facility_id string, "
    "branch_id string, partner_id string, service_type_id string, revenue_type string, "
    "revenue_amount_vnd bigint, cod_amount_vnd bigint, collected_at timestamp"
)

# Rows of the shipment tracker and of the stream-progress table.
JOURNEY = (
    "shipment_id string, status string, current_facility string, e2e_transit_s double, "
    "pickup_lead_s double, first_mile_s double, origin_po_dwell_s double, "
    "total_hub_dwell_s double, last_mile_s double, sla_committed_date string, "
    "delivered_date string, sla_met int, sla_breach int, attempt_count int, "
    "first_attempt_success int, is_redelivery int, updated_at timestamp"
)
ANOMALY = (
    "detected_at timestamp, shipment_id string, facility_id string, anomaly_type string, "
    "severity string, detail string"
)
PROGRESS = (
    "event_ts timestamp, query_name string, batch_id bigint, num_input_rows bigint, "
    "input_rows_per_second double, processed_rows_per_second double, "
    "batch_duration_ms bigint, add_batch_ms bigint, state_num_rows_total bigint, "
    "state_memory_bytes bigint, num_dropped_late_rows bigint"
)


# What a batch took in, as observed on the way through.
INTAKE = (
    "event_ts timestamp, query_id string, query_name string, batch_id bigint, num_input_rows bigint, "
    "total bigint, invalid bigint"
)


def columns_of(ddl: str) -> list[str]:
    """Column names of a DDL text; works before a session exists."""
    return re.findall(r"(\w+) [a-z]+", ddl)


def topic_schema(topic: str) -> T.StructType:
    """Wire schema of a topic: the envelope and every payload field."""
    return T.StructType.fromDDL(f"{ENVELOPE}, {PAYLOAD[topic]}")


def event_types(topic: str) -> list[str]:
    return list(EVENT_COLUMNS[topic])


def raw_columns(topic: str, event_type: str) -> list[str]:
    """Columns one event type keeps in its raw table."""
    names = f"{SHARED_COLUMNS[topic]} {EVENT_COLUMNS[topic][event_type]}".split()
    return columns_of(ENVELOPE) + names + columns_of(TRANSPORT)


def raw_schema(topic: str, event_type: str | None = None) -> T.StructType:
    """Raw-table schema of one event type, or of the whole topic."""
    full = T.StructType.fromDDL(f"{ENVELOPE}, {PAYLOAD[topic]}, {TRANSPORT}")
    if event_type is None:
        return full
    return T.StructType([full[name] for name in raw_columns(topic, event_type)])
