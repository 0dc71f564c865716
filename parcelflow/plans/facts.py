"""The five fact tables. Each takes cleaned topic frames and gives the rows of one window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import ExitStack
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow import model
from parcelflow.functions.dates import as_timestamp, date_key
from parcelflow.functions.measures import column_or_null, movement, status_of, utilisation
from parcelflow.model import FINANCIAL, SHIPMENT, TRACKING
from parcelflow.operators.dedup import first_per_key
from parcelflow.operators.lookup import lookup
from parcelflow.operators.upsert import (
    Rule,
    earliest,
    either,
    first_known,
    from_newer,
    latest,
    upsert,
)
from parcelflow.plans.inventory import roll_inventory
from parcelflow.plans.silver import CLEAN_TABLES
from parcelflow.sources.arrivals import Arrivals, arrivals
from parcelflow.sources.warehouse import Warehouse, create_fact_tables

# The events that end an attempt, and the one that brings its cash.
ATTEMPT_TYPES, COLLECTED = ("delivered", "failed_delivery"), "cod_collected"

# Milestone column -> normalised type and whether the first or last time counts.
MILESTONES = {
    "created_at": ("ORDER_CREATED", F.min),
    "pickedup_at": ("PICKED_UP", F.max),
    "origin_post_office_arrived_at": ("ARRIVED_AT_ORIGIN_POST_OFFICE", F.max),
    "origin_post_office_departed_at": ("DEPARTED_ORIGIN_POST_OFFICE", F.max),
    "first_hub_arrived_at": ("ARRIVED_AT_HUB", F.min),
    "last_hub_departed_at": ("DEPARTED_HUB", F.max),
    "dispatched_for_delivery_at": ("DISPATCHED_FOR_DELIVERY", F.max),
    "delivered_at": ("DELIVERED", F.max),
    "returned_at": ("RETURNED_TO_SENDER", F.max),
}


def _typed(df: DataFrame, ddl: str) -> DataFrame:
    """The columns of a fact in order, cast to the fact's types."""
    fields = T.StructType.fromDDL(ddl).fields
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def _static_columns() -> list[str]:
    """Columns of the shipment fact that come from its creation event."""
    names = model.columns_of(model.FACT_SHIPMENT)
    return [n for n in names[: names.index("current_status")] if n != "shipment_id"]


def movement_feed(shipment: DataFrame | None, tracking: DataFrame | None) -> DataFrame:
    """Shipment and tracking events in one shape, one scan each."""
    wanted = (
        "event_id string, event_type string, event_time timestamp, shipment_id string, "
        "event_type_norm string, facility_id string, pickup_facility_id string, "
        "route_id string, shipper_id string, assigned_shipper_id string, sequence_no int, "
        "kafka_partition int, kafka_offset bigint"
    )
    static = [n for n in _static_columns() if n != "pickup_facility_id"]
    out = None
    for df in (shipment, tracking):
        if df is None:
            continue
        columns = [
            column_or_null(df, f.name, f.dataType.simpleString())
            for f in T.StructType.fromDDL(wanted)
        ]
        part = df.select(*columns, *[c for c in static if c in df.columns])
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out.withColumns(
        {
            "place": F.coalesce("facility_id", "pickup_facility_id"),
            "carrier": F.coalesce("shipper_id", "assigned_shipper_id"),
        }
    )


def _late(delivered: Column, sla: Column) -> Column:
    """Delivered after the committed date; false unless both are known."""
    return F.coalesce(F.try_to_date(sla) < F.to_date(delivered), F.lit(False))


def _touched(feed: DataFrame, ids: DataFrame | None) -> DataFrame:
    """The rows with one of the ids, which are unique; all without ids.

    Both topics are joined at once, by the key that the fact is made by: their rows are shuffled once. An inner join stays
    above the union, where a semi join would be pushed to each side of it.
    """
    return feed if ids is None else feed.join(ids, ids.columns)


def fact_shipment(shipment: DataFrame | None, tracking: DataFrame | None, ids: DataFrame | None = None) -> DataFrame:
    """Accumulating snapshot: one row per shipment seen in the window, or of the ids only.

    Milestones, newest status and creation columns come out of a single aggregation.
    """
    feed = movement_feed(shipment, tracking)
    static = _static_columns()
    feed = feed.select("*", *[column_or_null(feed, c) for c in static if c not in feed.columns])
    is_creation = F.col("event_type") == "shipment_created"
    # What only a creation tells is one null in the other rows, which are most of those that travel.
    feed = feed.select(
        "shipment_id",
        "event_time",
        "event_type_norm",
        "place",
        "carrier",
        F.when(is_creation, F.struct("event_time", "kafka_partition", "kafka_offset")).alias("created"),
        F.when(is_creation, F.struct(*static)).alias("origin"),
    )
    milestones = [
        pick(F.when(F.col("event_type_norm") == norm, F.col("event_time"))).alias(name)
        for name, (norm, pick) in MILESTONES.items()
    ]
    rows = _touched(feed, ids).groupBy("shipment_id").agg(
        *milestones,
        F.max("carrier").alias("assigned_shipper_id"),
        F.max(F.struct("event_time", "event_type_norm", "place")).alias("newest"),
        F.min_by("origin", "created").alias("origin"),
    )
    out = rows.select(
        "shipment_id",
        *[F.col(f"origin.{c}").alias(c) for c in static],
        *MILESTONES,
        "assigned_shipper_id",
        status_of(F.col("newest.event_type_norm")).alias("current_status"),
        F.col("newest.place").alias("current_facility_id"),
        F.col("newest.event_time").alias("updated_at"),
        date_key(F.col("created_at")).alias("created_date_id"),
        date_key(F.col("delivered_at")).alias("delivered_date_id"),
        date_key(F.col("returned_at")).alias("returned_date_id"),
        F.col("returned_at").isNotNull().alias("is_returned"),
        F.lit(False).alias("is_lost"),
        _late(F.col("delivered_at"), F.col("origin.sla_committed_date")).alias("is_delayed"),
    )
    return _typed(out, model.FACT_SHIPMENT)


def _newer(name: str) -> Rule:
    return from_newer(name, "updated_at")


def _late_by_both(_: str) -> Rule:
    """Late by the newest delivery and promise of either side."""

    def rule(stored, incoming):
        done, promised = (F.coalesce(incoming(c), stored(c)) for c in ("delivered_at", "sla_committed_date"))
        return _late(done, promised)

    return rule


# The columns in which an update does more than fill a gap.
MERGED = {
    "is_delayed": _late_by_both,
    "created_at": earliest,
    "updated_at": latest,
    "first_hub_arrived_at": earliest,
    "last_hub_departed_at": latest,
    "is_lost": either,
    "is_returned": either,
    "current_status": _newer,
    "current_facility_id": _newer,
}


def shipment_rules() -> dict[str, Rule]:
    """How a window's shipment row updates the stored one."""
    return {c: MERGED.get(c, first_known)(c) for c in model.columns_of(model.FACT_SHIPMENT)}


def fact_shipment_route(shipment: DataFrame | None, tracking: DataFrame | None, ids: DataFrame | None = None) -> DataFrame:
    """One row per event, or of the ids only."""
    feed = _touched(movement_feed(shipment, tracking), ids).select(
        "event_id",
        "shipment_id",
        date_key(F.col("event_time")).alias("date_id"),
        F.col("place").alias("facility_id"),
        "route_id",
        F.col("carrier").alias("shipper_id"),
        "sequence_no",
        F.col("event_type_norm").alias("event_type"),
        "event_time",
        "kafka_partition",
        "kafka_offset",
    )
    unique = first_per_key(feed, ["event_id"], ["event_time", "kafka_partition", "kafka_offset"])
    return _typed(unique, model.FACT_ROUTE)


def fact_delivery_attempt(tracking: DataFrame, financial: DataFrame | None) -> DataFrame:
    """One row per shipment and attempt, with the cash collected on it."""
    keys = ["shipment_id", "attempt_no"]
    order = ["event_time", "kafka_partition", "kafka_offset"]
    tried = tracking.filter(F.col("event_type").isin(*ATTEMPT_TYPES))
    attempts = first_per_key(tried, keys, order).select(
        *keys,
        "shipper_id",
        "facility_id",
        date_key(F.col("event_time")).alias("date_id"),
        F.col("event_time").alias("attempt_ts"),
        F.when(F.col("event_type") == "delivered", "SUCCESS").otherwise("FAILED").alias("result"),
        column_or_null(tried, "failure_reason_code"),
        column_or_null(tried, "failure_reason_detail"),
    )
    if financial is None:
        cash = attempts.withColumn("cod_collected_vnd", F.lit(0))
    else:
        collected = first_per_key(
            financial.filter(F.col("event_type") == COLLECTED), keys, order
        ).select(*keys, F.col("cod_amount_vnd").alias("cod_collected_vnd"))
        cash = attempts.join(collected, keys, "left").fillna(0, ["cod_collected_vnd"])
    return _typed(cash, model.FACT_ATTEMPT)


def fact_financial_transaction(financial: DataFrame) -> DataFrame:
    """One row per financial event. The revenue types are fixed values."""
    kind = F.col("event_type")
    rows = financial.filter(kind.isin(model.event_types(FINANCIAL)))
    out = rows.select(
        "event_id",
        "shipment_id",
        F.col("event_time").alias("transaction_ts"),
        "facility_id",
        "branch_id",
        "partner_id",
        "service_type_id",
        F.when(kind == "shipping_fee_confirmed", "SHIPPING_FEE")
        .when(kind == "cod_collected", "COD_COLLECTION")
        .when(kind == "cod_failed", "COD_FAILED")
        .when(kind == "fee_adjusted", "FEE_ADJUSTMENT")
        .alias("revenue_type"),
        F.when(kind == "shipping_fee_confirmed", column_or_null(rows, "revenue_amount_vnd", "bigint"))
        .when(kind == "fee_adjusted", column_or_null(rows, "adjustment_amount_vnd", "bigint"))
        .otherwise(0)
        .alias("revenue_amount_vnd"),
        F.when(kind == "cod_collected", column_or_null(rows, "cod_amount_vnd", "bigint"))
        .otherwise(0)
        .alias("cod_amount_vnd"),
        F.when(kind == "cod_collected", F.col("event_time")).alias("collected_at"),
        "kafka_partition",
        "kafka_offset",
    )
    unique = first_per_key(
        out, ["event_id"], ["transaction_ts", "kafka_partition", "kafka_offset"]
    )
    return _typed(unique, model.FACT_FINANCIAL)


def net_presence(tracking: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Arrivals minus departures per facility and shipment, on top of an earlier result."""
    moves = tracking.select(
        "facility_id", "shipment_id", movement(F.col("event_type")).cast("bigint").alias("net")
    ).filter("net <> 0")
    if before is not None:
        moves = moves.unionByName(before.select("facility_id", "shipment_id", "net"))
    return moves.groupBy("facility_id", "shipment_id").agg(F.sum("net").alias("net"))


def fact_hub_inventory(
    presence: DataFrame, dims: Mapping[str, DataFrame], snapshot
) -> DataFrame:
    """Shipments present per facility at the snapshot time."""
    at = as_timestamp(snapshot)
    counts = presence.filter("net > 0").groupBy("facility_id").agg(
        F.count(F.lit(1)).alias("total_shipments")
    )
    capacity = dims["dim_facility"].select("facility_id", "capacity_per_day")
    rows = lookup(counts, capacity, ["facility_id"])
    out = rows.select(
        date_key(at).alias("date_id"),
        at.alias("snapshot_ts"),
        "facility_id",
        "total_shipments",
        utilisation(F.col("total_shipments"), F.col("capacity_per_day").cast("double")).alias(
            "capacity_utilization_pct"
        ),
    )
    return _typed(out, model.FACT_INVENTORY)


def build_gold(
    warehouse: Warehouse,
    dims: Mapping[str, DataFrame],
    start,
    end,
    roll_forward: bool = False,
) -> None:
    """All facts of [start, end). Running a window again gives the same tables.

    ``roll_forward`` corrects the inventory by the tracking rows that silver took in since the last
    run, late ones too; without it the inventory at ``end`` is counted from all history.
    """
    create_fact_tables(warehouse)
    shipment = warehouse.read_window(CLEAN_TABLES[SHIPMENT], start, end)
    tracking = warehouse.read_window(CLEAN_TABLES[TRACKING], start, end)
    financial = warehouse.read_window(CLEAN_TABLES[FINANCIAL], start, end)

    if shipment is not None or tracking is not None:
        upsert(
            warehouse,
            fact_shipment(shipment, tracking),
            "fact_shipment",
            ["shipment_id"],
            "created_at",
            shipment_rules(),
        )
        upsert(
            warehouse,
            fact_shipment_route(shipment, tracking),
            "fact_shipment_route",
            ["event_id"],
            "event_time",
        )
    if tracking is not None:
        upsert(
            warehouse,
            fact_delivery_attempt(tracking, financial),
            "fact_delivery_attempt",
            ["shipment_id", "attempt_no"],
            "attempt_ts",
        )
    if financial is not None:
        upsert(
            warehouse,
            fact_financial_transaction(financial),
            "fact_financial_transaction",
            ["event_id"],
            "transaction_ts",
        )
    if roll_forward:
        # Silver has ended its run, so all rows with its stamp are there.
        with arrivals(warehouse, "inventory", CLEAN_TABLES[TRACKING], "silver_loaded_at", settle_s=0) as taken:
            _roll(warehouse, dims, taken, end)
        return
    moves = warehouse.read_window(CLEAN_TABLES[TRACKING], None, end)
    if moves is not None:
        upsert(
            warehouse,
            fact_hub_inventory(net_presence(moves), dims, end),
            "fact_hub_inventory",
            ["facility_id", "snapshot_ts"],
            "snapshot_ts",
            key_fixes_partition=True,
        )


# Fact table -> the topics whose arrivals change it.
FACT_TOPICS = {
    "fact_shipment": (SHIPMENT, TRACKING),
    "fact_shipment_route": (SHIPMENT, TRACKING),
    "fact_delivery_attempt": (TRACKING, FINANCIAL),
    "fact_financial_transaction": (FINANCIAL,),
    "fact_hub_inventory": (TRACKING,),
}


def build_gold_arrivals(
    warehouse: Warehouse, dims: Mapping[str, DataFrame], snapshot, only=tuple(FACT_TOPICS), **options
) -> None:
    """Facts from the cleaned rows that arrived since each was last built, and an inventory at ``snapshot``.

    However late a row is, its fact ends as if all rows had been there from the start: shipments and
    attempts are made anew from all cleaned rows of the shipments that arrivals touch, events from
    those of their ids, since what fills a gap first must not depend on the order of arrival. ``options`` are those of ``arrivals``.
    """
    create_fact_tables(warehouse)
    for fact in only:
        with ExitStack() as reading:
            taken = {
                topic: reading.enter_context(arrivals(warehouse, fact, CLEAN_TABLES[topic], "silver_loaded_at", **options))
                for topic in FACT_TOPICS[fact]
            }
            arrived = {topic: t.rows for topic, t in taken.items() if t.rows is not None}
            if fact == "fact_hub_inventory":
                _roll(warehouse, dims, taken[TRACKING], snapshot)
            elif arrived:
                _upsert_arrived(warehouse, fact, arrived)


def _roll(warehouse: Warehouse, dims: Mapping[str, DataFrame], taken: Arrivals, snapshot) -> None:
    """A snapshot is due also where nothing has arrived."""
    if not warehouse.exists(CLEAN_TABLES[TRACKING]):
        return
    if taken.rows is None:
        roll_inventory(warehouse, dims, warehouse.read(CLEAN_TABLES[TRACKING]).limit(0), snapshot, f"none at {snapshot}")
    else:
        roll_inventory(warehouse, dims, taken.rows, snapshot, taken.run)


def _upsert_arrived(warehouse: Warehouse, fact: str, arrived: Mapping[str, DataFrame]) -> None:
    if fact == "fact_shipment":
        whole, ids = _cleaned(warehouse, FACT_TOPICS[fact]), _ids(arrived, "shipment_id")
        rows, keys, ts = fact_shipment(whole.get(SHIPMENT), whole.get(TRACKING), ids), ["shipment_id"], "created_at"
    elif fact == "fact_shipment_route":
        # Events of two types may share an id; the first of all of them counts.
        whole, ids = _cleaned(warehouse, FACT_TOPICS[fact]), _ids(arrived, "event_id")
        rows, keys, ts = fact_shipment_route(whole.get(SHIPMENT), whole.get(TRACKING), ids), ["event_id"], "event_time"
    elif fact == "fact_financial_transaction":
        whole = _of_touched(warehouse, arrived, FACT_TOPICS[fact], key="event_id")
        rows, keys, ts = fact_financial_transaction(whole[FINANCIAL]), ["event_id"], "transaction_ts"
    else:
        kinds = {TRACKING: ATTEMPT_TYPES, FINANCIAL: (COLLECTED,)}
        whole = _of_touched(warehouse, arrived, FACT_TOPICS[fact], kinds=kinds)
        if TRACKING not in whole:
            return
        rows, keys, ts = fact_delivery_attempt(whole[TRACKING], whole.get(FINANCIAL)), ["shipment_id", "attempt_no"], "attempt_ts"
    upsert(warehouse, rows, fact, keys, ts)


def _ids(arrived: Mapping[str, DataFrame], key: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [rows.select(key) for rows in arrived.values()]).distinct()


def _cleaned(warehouse: Warehouse, topics: Sequence[str]) -> dict[str, DataFrame]:
    return {topic: warehouse.read(CLEAN_TABLES[topic]) for topic in topics if warehouse.exists(CLEAN_TABLES[topic])}


def _of_touched(
    warehouse: Warehouse, arrived: Mapping[str, DataFrame], topics: Sequence[str], key: str = "shipment_id",
    kinds: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, DataFrame]:
    """All cleaned rows, per topic, of the shipments (or other keys) with an arrival; of some event types only if told so."""

    def some(topic: str, rows: DataFrame) -> DataFrame:
        return rows.filter(F.col("event_type").isin(*kinds[topic])) if kinds else rows

    ids = _ids({topic: some(topic, rows) for topic, rows in arrived.items()}, key)
    return {topic: some(topic, rows).join(ids, key, "left_semi") for topic, rows in _cleaned(warehouse, topics).items()}
