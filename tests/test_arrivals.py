"""What arrives late, again, or unreadable: the ledger, cleaned rows, facts, inventory and dead letters."""

from __future__ import annotations

import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from parcelflow.catalogue.feeds import dimensions, topic_feed
from parcelflow.catalogue.tables import arriving, filled_raw, with_raw_columns
from parcelflow.model import FINANCIAL, SHIPMENT, TRACKING
from parcelflow.operators.upsert import upsert
from parcelflow.plans import facts, inventory, silver
from parcelflow.session import new_scratch
from parcelflow.sources.arrivals import arrivals, ledger_entry
from parcelflow.sources.topics import decode
from parcelflow.sources.warehouse import ARRIVED, RAW_TABLES, Warehouse, create_raw_tables
from parcelflow.streaming.sinks import DEAD_TABLE, raw_writer

CUT = "1998-06-01 00:00:00"


@pytest.fixture()
def warehouse(spark):
    name = "a" + uuid.uuid4().hex[:8]
    return Warehouse(spark, name, location=new_scratch(spark, name), grain="year")


def _ids(df):
    return sorted(r.id for r in df.collect())


def test_ledger_hands_each_row_on_once_and_again_after_a_failure(spark, warehouse):
    ddl = f"id int, at timestamp, {ARRIVED} date"
    warehouse.create("x", ddl, None, by=[ARRIVED])

    def put(*rows):
        df = spark.createDataFrame([(i, datetime(2024, 1, d)) for i, d in rows], "id int, at timestamp")
        warehouse.append(df.withColumn(ARRIVED, warehouse.day_of(F.col("at"))), "x")

    put((1, 1), (2, 3))
    with pytest.raises(RuntimeError), arrivals(warehouse, "c", "x", "at") as taken:
        first = taken.run
        raise RuntimeError
    put((3, 9))
    with arrivals(warehouse, "c", "x", "at") as taken:
        assert (_ids(taken.rows), taken.run) == ([1, 2], first)
        text = taken.rows._jdf.queryExecution().executedPlan().toString()
        assert f"PartitionFilters: [isnotnull({ARRIVED}" in text
    with arrivals(warehouse, "c", "x", "at", upto="2024-01-05 00:00:00") as taken:
        assert taken.rows is None
    with arrivals(warehouse, "c", "x", "at") as taken:
        assert _ids(taken.rows) == [3]
    with arrivals(warehouse, "c", "x", "at") as taken:
        assert taken.rows is None
    with arrivals(warehouse, "other", "x", "at") as taken:
        assert _ids(taken.rows) == [1, 2, 3]
    assert ledger_entry(warehouse, "c", "x") == (datetime(2024, 1, 9), None)
    with arrivals(warehouse, "c", "missing", "at") as taken:
        assert taken.rows is None


def test_rows_too_young_to_be_settled_wait(spark, warehouse):
    warehouse.replace("y", spark.range(1).select(F.col("id"), F.current_timestamp().alias("at")))
    with arrivals(warehouse, "c", "y", "at", settle_s=3600) as taken:
        assert taken.rows is None
    with arrivals(warehouse, "c", "y", "at", settle_s=0) as taken:
        assert _ids(taken.rows) == [0]


def _same(a, b):
    columns = sorted(a.columns)
    left, right = a.select(columns), b.select(columns)
    return left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def test_facts_by_arrival_equal_those_of_one_window(spark, sf_dir, warehouse):
    """All five facts, in two runs; the second also brings rows of the first one's time and cash for its attempts."""
    dims = dimensions(spark, sf_dir)
    filled_raw(spark, sf_dir, warehouse)
    for number, (upto, snapshot) in enumerate([(CUT, "1997-01-01 00:00:00"), (None, "2002-01-01 00:00:00")], 1):
        stamp = F.lit(f"2001-01-0{number} 00:00:00").cast("timestamp")
        silver.build_silver_arrivals(warehouse, dims, stamp=stamp, upto=upto)
        facts.build_gold_arrivals(warehouse, dims, snapshot)
    clean = {t: warehouse.read(silver.CLEAN_TABLES[t]) for t in (SHIPMENT, TRACKING, FINANCIAL)}
    assert _same(warehouse.read("fact_shipment"), facts.fact_shipment(clean[SHIPMENT], clean[TRACKING]))
    assert _same(warehouse.read("fact_shipment_route"), facts.fact_shipment_route(clean[SHIPMENT], clean[TRACKING]))
    assert _same(warehouse.read("fact_delivery_attempt"), facts.fact_delivery_attempt(clean[TRACKING], clean[FINANCIAL]))
    assert _same(warehouse.read("fact_financial_transaction"), facts.fact_financial_transaction(clean[FINANCIAL]))
    for snapshot in ("1997-01-01 00:00:00", "2002-01-01 00:00:00"):
        at = F.lit(snapshot).cast("timestamp")
        want = facts.fact_hub_inventory(facts.net_presence(clean[TRACKING].filter(F.col("event_time") < at)), dims, snapshot)
        assert want.count() > 0 and _same(warehouse.read("fact_hub_inventory").filter(F.col("snapshot_ts") == at), want)
    rejected = warehouse.read(silver.REJECTED_TABLES[SHIPMENT])
    assert rejected.filter("array_contains(dq_flags, 'NULL_EVENT_TIME') AND event_time IS NULL").count() > 0
    late = clean[SHIPMENT].filter((F.col("event_time") < F.lit("1997-01-01").cast("timestamp")) & (F.dayofmonth("silver_loaded_at") == 2))
    assert late.count() > 0


def test_a_match_is_found_though_it_arrived_another_day(spark, warehouse):
    warehouse.grain = "day"
    ddl = f"k string, t timestamp, v string, {ARRIVED} date"
    d = lambda day: datetime(2024, 1, day)

    def put(*rows):
        upsert(warehouse, spark.createDataFrame([(k, d(t), v, d(a).date()) for k, t, v, a in rows], ddl), "m", ["k"], "t", by=[ARRIVED], key_fixes_partition=True)

    put(("a", 1, "a1", 2), ("b", 1, "b1", 2), ("c", 3, "c1", 4))
    put(("a", 1, "a2", 9))
    stored = {r.k: (r.v, r[ARRIVED].day, r.day.day) for r in warehouse.stored("m").collect()}
    assert stored == {"a": ("a2", 9, 1), "b": ("b1", 2, 1), "c": ("c1", 4, 3)} and warehouse.stored("m").count() == 3


MOVES = "event_id string, event_type string, facility_id string, shipment_id string, event_time timestamp"


def _counts(warehouse):
    return {(r.snapshot_ts.day, r.facility_id): r.total_shipments for r in warehouse.read(inventory.FACT).collect()}


def test_inventory_takes_late_repeated_and_changed_moves(spark, warehouse):
    dims = {"dim_facility": spark.createDataFrame([("A", 10), ("B", 10)], "facility_id string, capacity_per_day int")}
    warehouse.grain = "day"
    d = lambda day, hour=0: datetime(2024, 1, day, hour)

    def roll(run, snapshot, *rows):
        inventory.roll_inventory(warehouse, dims, spark.createDataFrame(list(rows), MOVES), snapshot, run)

    into = lambda i, f, s, at: (i, "arrived_at_hub", f, s, at)
    out = lambda i, f, s, at: (i, "departed_hub", f, s, at)
    roll("r1", d(2), into("1", "A", "x", d(1)), into("2", "A", "y", d(1)), into("9", "A", "z", d(5)))
    assert _counts(warehouse) == {(2, "A"): 2}
    roll("r2", d(3), out("3", "A", "x", d(2, 5)), into("4", "B", "x", d(2, 6)))
    assert _counts(warehouse) == {(2, "A"): 2, (3, "A"): 1, (3, "B"): 1}
    # y had left before the first snapshot; event 4 comes again as it was, event 3 with another time.
    late = (out("5", "A", "y", d(1, 3)), into("4", "B", "x", d(2, 6)), out("3", "A", "x", d(3, 9)))
    for _ in range(2):
        roll("r3", d(4), *late)
        assert _counts(warehouse) == {(2, "A"): 1, (3, "A"): 1, (3, "B"): 1, (4, "B"): 1}
    # An old run made again changes nothing; a snapshot without any move counts what is there by then.
    roll("r2", d(3), out("3", "A", "x", d(2, 5)), into("4", "B", "x", d(2, 6)))
    roll("r4", d(6), *[])
    assert _counts(warehouse)[6, "A"] == 1 and _counts(warehouse)[6, "B"] == 1
    # All leave, from the start on: no row is left of a day.
    roll("r5", d(7), out("6", "A", "z", d(5)), out("7", "B", "x", d(2, 6)), out("8", "A", "x", d(1)))
    assert (2, "A") not in _counts(warehouse) and not any(day >= 6 for day, _ in _counts(warehouse))


def test_every_line_is_a_raw_row_or_a_dead_letter(spark, warehouse):
    create_raw_tables(warehouse)
    good = '{"event_id":"%s","event_type":"arrived_at_hub","event_time":"2024-01-01T00:00:00Z","shipment_id":"S","sequence_no":%s}'
    lines = [good % (1, 1), good % (2, '"no number"'), '{"event_id":"3"}', '{"event_type":"teleported"}', "{broken", "", "[1]", None]
    raw = spark.createDataFrame([(0, i, v) for i, v in enumerate(lines)], "kafka_partition int, kafka_offset long, raw_value string")
    write = raw_writer(warehouse, TRACKING, lambda b: f"q-{b}")
    write(decode(raw, TRACKING), 0)
    dead = lambda: {r.kafka_offset: (r.reason, r.raw_value) for r in warehouse.read(DEAD_TABLE).collect()}
    assert sorted(r.event_id for r in warehouse.read(RAW_TABLES[TRACKING]).collect()) == ["1", "2"]
    assert {k: v[0] for k, v in dead().items()} == {2: "NO_TYPE", 3: "UNKNOWN_TYPE", 4: "UNREADABLE", 5: "UNREADABLE", 6: "UNREADABLE", 7: "UNREADABLE"}
    assert dead()[4] == ("UNREADABLE", "{broken")
    write(decode(raw, TRACKING), 0)
    assert len(dead()) == 6 == warehouse.read(DEAD_TABLE).count()


def test_rows_that_were_not_decoded_here_are_kept_as_json(spark, sf_dir, warehouse):
    create_raw_tables(warehouse)
    rows = with_raw_columns(arriving(topic_feed(spark, sf_dir, TRACKING), F.lit(False)), TRACKING).limit(50)
    raw_writer(warehouse, TRACKING)(rows.withColumn("event_type", F.lit("unheard_of")), 3)
    kept = warehouse.read(DEAD_TABLE).collect()
    assert len(kept) == 50 and all('"event_type":"unheard_of"' in r.raw_value and r.reason == "UNKNOWN_TYPE" for r in kept)
