"""What an upsert and the facts by arrival write and shuffle."""

from __future__ import annotations

import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from parcelflow.catalogue import tables
from parcelflow.model import SHIPMENT
from parcelflow.operators.dedup import first_per_key
from parcelflow.operators.upsert import Rule, _merged, upsert
from parcelflow.plans import facts
from parcelflow.session import new_scratch, session_conf
from parcelflow.sources.warehouse import Warehouse

DDL = "k string, part string, at timestamp, v int"
NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture()
def warehouse(spark):
    name = "v" + uuid.uuid4().hex[:8]
    return Warehouse(spark, name, location=new_scratch(spark, name))


def _day(number: int) -> datetime:
    return datetime(2024, 1, number)


def _rows(warehouse):
    return sorted(((r.k, r.part, r.at.day, r.v, r.day.day) for r in warehouse.stored("t").collect()), key=str)


def _shuffles(df) -> list[str]:
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]


def test_an_upsert_stages_no_copy_and_tables_are_packed(spark, warehouse, monkeypatch):
    def staged(*_):
        raise AssertionError("a copy was staged")

    monkeypatch.setattr(warehouse, "replace", staged)
    for value in (1, 2):
        upsert(warehouse, spark.createDataFrame([("a", "x", _day(1), value), ("b", "y", _day(2), value)], DDL), "t", ["k"], "at", by=["part"])
    assert _rows(warehouse) == [("a", "x", 1, 2, 1), ("b", "y", 2, 2, 2)]
    files = [f.rsplit("/", 1)[1] for f in warehouse.stored("t").inputFiles()]
    assert files and all(".zstd." in f for f in files)


def test_null_keys_repeated_stored_keys_and_emptied_partitions(spark, warehouse):
    """One run that moves rows, fills a new partition, empties two and leaves one alone."""
    first = [("a", "x", _day(1), 1), ("b", "x", _day(2), 1), (None, "x", _day(3), 1), ("c", "y", _day(4), 1), ("d", "z", _day(5), 1)]
    upsert(warehouse, spark.createDataFrame(first, DDL), "t", ["k"], "at", by=["part"])
    # A table that another writer filled may hold a key twice: both rows are updated.
    warehouse.append(spark.createDataFrame([("c", "y", _day(6), 7)], DDL), "t", "at")
    untouched = lambda: [f for f in warehouse.stored("t").inputFiles() if "part=z" in f]
    left_alone = untouched()
    second = [("a", "w", _day(1), 2), (None, "x", _day(2), 2), ("c", "y", _day(4), 2), ("e", "x", _day(9), 2)]
    upsert(warehouse, spark.createDataFrame(second, DDL), "t", ["k"], "at", by=["part"])
    assert _rows(warehouse) == sorted(
        [("a", "w", 1, 2, 1), ("b", "x", 2, 1, 2), (None, "x", 2, 2, 2), ("c", "y", 4, 2, 4), ("c", "y", 4, 2, 4), ("d", "z", 5, 1, 5), ("e", "x", 9, 2, 9)],
        key=str,
    )
    assert left_alone and untouched() == left_alone


def test_a_row_that_a_rule_places_elsewhere_keeps_the_rows_there(spark, warehouse):
    """The merged row's partition is that of neither side; what stands there stays."""
    upsert(warehouse, spark.createDataFrame([("a", "x", _day(1), 1), ("b", "xy", _day(1), 1)], DDL), "t", ["k"], "at", by=["part"])
    both: Rule = lambda t, s: F.concat(t("part"), s("part"))
    upsert(warehouse, spark.createDataFrame([("a", "y", _day(1), 2)], DDL), "t", ["k"], "at", {"part": both}, by=["part"])
    assert _rows(warehouse) == [("a", "xy", 1, 2, 1), ("b", "xy", 1, 1, 1)]


def test_rows_made_by_their_key_are_not_shuffled_again_to_be_merged(spark, tmp_path):
    spark.range(50).selectExpr("concat('k', id % 40) AS k", "id % 3 AS n", "id AS v").write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    with session_conf(spark, NO_BROADCAST):
        merged = _merged(rows, first_per_key(rows, ["k"], ["v"]), ["k"], [F.col("s.v")])
        by_key = [line for line in _shuffles(merged) if "coalesce" not in line]
    # The target, the source's dedup, and that of its rows without a key.
    assert len(by_key) == 3


def test_the_shipment_fact_shuffles_its_rows_once(spark, tmp_path):
    ddl = (
        "event_id string, event_type string, event_time timestamp, shipment_id string, event_type_norm string, "
        "facility_id string, kafka_partition int, kafka_offset bigint"
    )
    kinds = [("shipment_created", "ORDER_CREATED"), ("delivered", "DELIVERED")]
    for kind, norm in kinds:
        made = [(f"{kind}{i}", kind, _day(1 + i), f"S{i}", norm, "F", 0, i) for i in range(4)]
        spark.createDataFrame(made, ddl).write.parquet(str(tmp_path / kind))
    shipment, tracking = (spark.read.parquet(str(tmp_path / kind)) for kind, _ in kinds)
    ids = shipment.select("shipment_id").filter("shipment_id < 'S2'").distinct()
    with session_conf(spark, NO_BROADCAST):
        fact = facts.fact_shipment(shipment, tracking, ids)
        assert len(_shuffles(fact)) == 2
        got = {r.shipment_id: (r.created_at, r.delivered_at) for r in fact.collect()}
    assert got == {"S0": (_day(1), _day(1)), "S1": (_day(2), _day(2))}


def test_raw_rows_are_made_in_small_splits(spark, sf_dir, warehouse, monkeypatch):
    """What a task sorts stays small; the session gets its own split size back."""
    key, seen = "spark.sql.files.maxPartitionBytes", []
    before = spark.conf.get(key)
    monkeypatch.setattr(tables, "raw_writer", lambda *_: lambda rows, batch: seen.append((spark.conf.get(key), rows.isEmpty())))
    tables.filled_raw(spark, sf_dir, warehouse, [SHIPMENT])
    assert seen == [(tables.FEED_SPLIT, False)] and spark.conf.get(key) == before
