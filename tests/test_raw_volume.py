"""What writing raw rows and dead letters keeps in memory and reads."""

from __future__ import annotations

import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from parcelflow.catalogue.tables import filled_raw
from parcelflow.model import SHIPMENT, TRACKING
from parcelflow.session import new_scratch
from parcelflow.sources.topics import decode
from parcelflow.sources.warehouse import RAW_TABLES, Warehouse, create_raw_tables
from parcelflow.streaming.sinks import DEAD_TABLE, raw_writer

GOOD = '{"event_id":"%d","event_type":"arrived_at_hub","event_time":"2024-01-01T00:00:00Z","shipment_id":"S"}'


@pytest.fixture()
def warehouse(spark):
    name = "w" + uuid.uuid4().hex[:8]
    made = Warehouse(spark, name, location=new_scratch(spark, name))
    create_raw_tables(made)
    return made


@pytest.fixture()
def lines(spark, tmp_path):
    rows = [(i % 2, i, GOOD % i if i % 3 else "{broken") for i in range(12)]
    path = str(tmp_path / "lines")
    spark.createDataFrame(rows, "kafka_partition int, kafka_offset long, raw_value string").write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("keep", [False, True])
def test_only_a_bounded_batch_is_kept_in_memory(spark, warehouse, lines, monkeypatch, keep):
    kept, frame = [], type(lines)
    persist = frame.persist
    monkeypatch.setattr(frame, "persist", lambda self, *level: kept.append(1) or persist(self, *level))
    raw_writer(warehouse, TRACKING, **({"keep": True} if keep else {}))(decode(lines, TRACKING), 0)
    assert bool(kept) == keep
    raw = warehouse.read(RAW_TABLES[TRACKING]).select("event_id", "event_time").collect()
    assert sorted((int(r.event_id), r.event_time) for r in raw) == [(i, datetime(2024, 1, 1)) for i in range(12) if i % 3]
    dead = warehouse.read(DEAD_TABLE).select("kafka_offset", "reason", "raw_value").collect()
    assert sorted(map(tuple, dead)) == [(i, "UNREADABLE", "{broken") for i in range(0, 12, 3)]


def test_a_filter_on_an_event_does_not_parse_its_text_again(lines):
    some = decode(lines, TRACKING).filter(F.col("event_type").isNull() | F.col("event_type").isin("delivered", "arrived_at_hub"))
    plan = some.filter(F.col("kafka_partition") == 0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1
    # What does not come out of the text is still sought in the file.
    assert "PushedFilters: [IsNotNull(kafka_partition), EqualTo(kafka_partition,0)]" in plan


def test_raw_tables_are_filled_without_a_copy_in_memory(spark, tmp_path, warehouse, monkeypatch):
    columns = "id AS o_orderkey, id AS o_custkey, 'F' AS o_orderstatus, 1e5D AS o_totalprice, TIMESTAMP_NTZ'1996-01-01' AS o_orderdate"
    spark.range(20).selectExpr(*columns.split(", "), "'5-LOW' AS o_orderpriority").write.parquet(str(tmp_path / "orders.parquet"))

    def kept(*_):
        raise AssertionError("a batch was kept")

    monkeypatch.setattr(type(spark.range(1)), "persist", kept)
    filled_raw(spark, str(tmp_path), warehouse, [SHIPMENT])
    assert warehouse.read(RAW_TABLES[SHIPMENT]).count() == 20 and warehouse.read(DEAD_TABLE).isEmpty()
