"""Tables, upserts and the batch runs on them."""

from __future__ import annotations

import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from parcelflow import model
from parcelflow.catalogue.feeds import dimensions, topic_feed
from parcelflow.functions.measures import fill_unknown
from parcelflow.model import SHIPMENT, TRACKING
from parcelflow.operators.upsert import earliest, first_known, merge_rows, upsert
from parcelflow.plans import facts, silver
from parcelflow.session import new_scratch
from parcelflow.sources.dimensions import build_dimensions, load_dimensions
from parcelflow.sources.warehouse import (
    FACT_TABLES,
    RAW_TABLES,
    Warehouse,
    create_raw_tables,
    raw_events,
)
from parcelflow.streaming.sinks import jdbc_append, raw_writer

START, MIDDLE, END = "1990-01-01 00:00:00", "1998-06-01 00:00:00", "2010-01-01 00:00:00"


@pytest.fixture()
def warehouse(spark):
    name = "w" + uuid.uuid4().hex[:8]
    return Warehouse(spark, name, location=new_scratch(spark, name))


def loaded(spark, sf_dir, warehouse):
    """Raw tables of the feeds. They span seven years thinly, hence a coarse grain."""
    warehouse.grain = "year"
    create_raw_tables(warehouse)
    for topic in model.TOPICS:
        rows = topic_feed(spark, sf_dir, topic)
        have = set(rows.columns)
        rows = rows.select(
            "*",
            *[
                F.lit(None).cast(f.dataType).alias(f.name)
                for f in model.raw_schema(topic)
                if f.name not in have
            ],
        )
        raw_writer(warehouse, topic)(rows, 0)
    return dimensions(spark, sf_dir)


def same(a, b):
    columns = sorted(a.columns)
    left, right = a.select(columns), b.select(columns)
    return left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def test_window_is_half_open_and_prunes_days(spark, warehouse):
    rows = [(i, datetime(2024, 1, 1 + i, 12)) for i in range(5)]
    df = spark.createDataFrame(rows, "id int, t timestamp")
    warehouse.like(df, "x", "t")
    assert warehouse.stored("x").count() == 0
    warehouse.append(df, "x", "t")
    got = warehouse.read_window("x", "2024-01-02 12:00:00", "2024-01-04 12:00:00", "t")
    assert sorted(r.id for r in got.collect()) == [1, 2]
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in text
    assert warehouse.read_window("missing", START, END) is None
    assert warehouse.read_window("x", None, "2024-01-02 00:00:00", "t").count() == 1


def test_upsert_moves_rows_between_days(spark, warehouse):
    ddl = "k string, created_at timestamp, v string"
    d = lambda day: datetime(2024, 1, day)
    rules = {"created_at": earliest("created_at"), "v": first_known("v")}

    def put(rows):
        upsert(warehouse, spark.createDataFrame(rows, ddl), "f", ["k"], "created_at", rules)

    put([("a", d(5), "a1"), ("b", d(5), None), ("c", d(9), "c1"), ("n", None, "n1")])
    put([("a", d(3), "a2"), ("b", d(7), "b2"), ("n", d(2), None), ("e", d(3), "e1")])
    rows = {r.k: (r.created_at, r.v, r.day) for r in warehouse.stored("f").collect()}
    assert rows == {
        "a": (d(3), "a1", date(2024, 1, 3)),
        "b": (d(5), "b2", date(2024, 1, 5)),
        "c": (d(9), "c1", date(2024, 1, 9)),
        "n": (d(2), "n1", date(2024, 1, 2)),
        "e": (d(3), "e1", date(2024, 1, 3)),
    }
    put([("b", d(4), None)])  # leaves day 5 empty
    assert {r.k: r.day.day for r in warehouse.stored("f").collect()}["b"] == 4
    assert not warehouse.exists("f__incoming") and not warehouse.exists("f__outgoing")


def test_upsert_refuses_repeated_keys(spark, warehouse):
    rows = [("a", datetime(2024, 1, 1)), ("a", datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "k string, t timestamp")
    with pytest.raises(Exception, match="repeats a key"):
        upsert(warehouse, df, "u", ["k"], "t")
    assert warehouse.stored("u").count() == 0


@pytest.fixture(scope="module")
def filled(spark, sf_dir):
    """A database with the raw tables, shared by the runs below."""
    name = "w" + uuid.uuid4().hex[:8]
    warehouse = Warehouse(spark, name, location=new_scratch(spark, name))
    return warehouse, loaded(spark, sf_dir, warehouse)


def test_raw_tables_keep_only_a_types_columns(filled):
    warehouse = filled[0]
    rows = raw_events(warehouse, TRACKING, "arrived_at_hub")
    assert rows.columns == model.raw_columns(TRACKING, "arrived_at_hub")
    assert rows.count() > 0
    stored = warehouse.read(RAW_TABLES[TRACKING]).filter("event_type = 'sorted_at_hub'")
    assert stored.filter("route_id IS NOT NULL OR attempt_no IS NOT NULL").count() == 0
    assert model.raw_schema(TRACKING, "delivered")["attempt_no"].dataType.simpleString() == "int"


def test_silver_and_gold_runs(spark, filled, tmp_path):
    warehouse, dims = filled
    results = str(tmp_path / "dq")
    silver.build_silver(warehouse, dims, START, END, results)
    clean = {t: warehouse.read(silver.CLEAN_TABLES[t]) for t in model.TOPICS}
    pure = {
        t: silver.cleaned(warehouse.read(RAW_TABLES[t]), t, dims)[0].drop("silver_loaded_at")
        for t in (SHIPMENT, TRACKING)
    }
    assert same(clean[TRACKING].drop("silver_loaded_at"), pure[TRACKING])
    assert same(clean[SHIPMENT].drop("silver_loaded_at"), pure[SHIPMENT])
    rejected = warehouse.read(silver.REJECTED_TABLES[SHIPMENT])
    assert rejected.count() > 0 and rejected.filter("size(dq_flags) = 0").count() == 0
    checks = spark.read.json(results)
    assert checks.filter("event_type = 'shipment_created' AND NOT success").count() > 0

    facts.build_gold(warehouse, dims, START, END)
    assert same(
        warehouse.read("fact_shipment"), facts.fact_shipment(clean[SHIPMENT], clean[TRACKING])
    )
    rows = {}
    for table in FACT_TABLES:
        rows[table] = sorted(map(str, warehouse.read(table).collect()))
        assert rows[table]
    # Once more over the same window: nothing changes.
    facts.build_gold(warehouse, dims, START, END)
    for table in FACT_TABLES:
        assert sorted(map(str, warehouse.read(table).collect())) == rows[table], table


def test_two_windows_equal_the_merged_facts(filled):
    warehouse, dims = filled
    for table in [*silver.CLEAN_TABLES.values(), *silver.REJECTED_TABLES.values(), *FACT_TABLES]:
        warehouse.drop(table)
    windows = ((START, MIDDLE), (MIDDLE, END))
    for window in windows:
        silver.build_silver(warehouse, dims, *window)
    clean = {t: warehouse.read(silver.CLEAN_TABLES[t]) for t in model.TOPICS}
    repeats = clean[TRACKING].groupBy("event_type", "event_id").count().filter("count > 1")
    assert repeats.count() == 0
    for window in windows:
        facts.build_gold(warehouse, dims, *window, roll_forward=True)
    parts = [
        facts.fact_shipment(
            *[warehouse.read_window(silver.CLEAN_TABLES[t], *w) for t in (SHIPMENT, TRACKING)]
        )
        for w in windows
    ]
    want = merge_rows(*parts, ["shipment_id"], facts.shipment_rules())
    assert same(warehouse.read("fact_shipment"), want)
    # Rolled forward over two windows or counted over all time: the same inventory.
    snapshot = facts.fact_hub_inventory(facts.net_presence(clean[TRACKING]), dims, END)
    last = F.col("snapshot_ts") == F.lit(END).cast("timestamp")
    assert same(warehouse.read("fact_hub_inventory").filter(last), snapshot)


def test_dimension_tables_from_files(spark, warehouse, tmp_path):
    (tmp_path / "b.csv").write_text("branch_id,branch_name,region_id\nB1,One,R1\nB2,Two,\n")
    spark.createDataFrame([("R1", "North")], "region_id string, region_name string").write.parquet(str(tmp_path / "r"))
    specs = [
        {"source_table": "dim_branch", "source_format": "csv", "source_path": str(tmp_path / "b.csv")},
        {"source_table": "dim_region", "source_format": "parquet", "source_path": str(tmp_path / "r")},
    ]
    build_dimensions(warehouse, specs)
    build_dimensions(warehouse, specs)
    dims = load_dimensions(warehouse, ["dim_branch", "dim_region"])
    assert dims["dim_branch"].count() == 2 and dims["dim_region"].first()["region_name"] == "North"


def test_relational_append(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/serving;create=true"
    append = jdbc_append(url, {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    rows = fill_unknown(spark.createDataFrame([("F1", 3), (None, 4)], "facility_id string, n int"))
    append(rows, "kpi", 0)
    append(rows, "kpi", 1)
    stored = spark.read.jdbc(url, "kpi", properties={"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    assert sorted((r[0], r[1]) for r in stored.collect()) == [("F1", 3), ("F1", 3), ("UNKNOWN", 4), ("UNKNOWN", 4)]
