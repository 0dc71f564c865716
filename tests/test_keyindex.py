"""Upserts that find their partitions by the key index."""

from __future__ import annotations

import uuid
from datetime import datetime

import pytest

from parcelflow.operators.keyindex import BUCKET, KeyIndex
from parcelflow.operators.upsert import earliest, upsert
from parcelflow.session import new_scratch
from parcelflow.sources.warehouse import Warehouse

RULES = {"at": earliest("at")}


@pytest.fixture()
def warehouse(spark):
    name = "k" + uuid.uuid4().hex[:8]
    return Warehouse(spark, name, location=new_scratch(spark, name))


def _rows(spark, *rows):
    at = [(k, None if day is None else datetime(2024, 1, day), n) for k, day, n in rows]
    return spark.createDataFrame(at, "k string, at timestamp, n int")


def _read(warehouse, table):
    return sorted((tuple(r) for r in warehouse.read(table).collect()), key=str)


def test_same_rows_as_by_the_search_of_all_keys(spark, warehouse):
    # Rows move to an earlier day and again, keys and times are null, one run is empty.
    runs = [
        [("a", 5, 1), ("b", 5, 1), (None, 7, 1), ("c", None, 1)],
        [("a", 3, 2), ("d", 9, 2), (None, 6, 2)],
        [],
        [("a", 2, 3), ("b", 5, 3), ("c", 4, 3), ("d", 9, 3)],
    ]
    for run in runs:
        upsert(warehouse, _rows(spark, *run), "searched", ["k"], "at", RULES)
        upsert(warehouse, _rows(spark, *run), "indexed", ["k"], "at", RULES, index_buckets=4)
        assert _read(warehouse, "indexed") == _read(warehouse, "searched")
    assert [r[0] for r in _read(warehouse, "indexed")].count("a") == 1


def test_a_run_of_few_keys_reads_their_buckets_only(spark, warehouse):
    upsert(warehouse, _rows(spark, *[(str(i), 1 + i % 20, i) for i in range(200)]), "t", ["k"], "at", index_buckets=32)
    index = KeyIndex(warehouse, "t", ["k"], 32)
    found = index.places(_rows(spark, ("7", 1, 0)))
    assert [str(r.day) for r in found.collect()] == ["2024-01-08"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert f"{BUCKET}" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    read = set(found.inputFiles())
    every = set(warehouse.stored("t__keys").inputFiles())
    assert len(read & every) == 1 and len(every) > 20


def test_index_of_a_filled_table_or_an_unfinished_one_is_made_anew(spark, warehouse):
    upsert(warehouse, _rows(spark, ("a", 5, 1), ("b", 6, 1)), "t", ["k"], "at")
    # As a build that was lost between its two steps leaves it.
    index = KeyIndex(warehouse, "t", ["k"], 4)
    schema = warehouse.stored("t__keys").schema
    warehouse.drop("t__keys")
    warehouse.create("t__keys", schema, None, by=[BUCKET])
    upsert(warehouse, _rows(spark, ("a", 1, 2)), "t", ["k"], "at", index_buckets=4)
    assert _read(warehouse, "t") == [("a", datetime(2024, 1, 1), 2), ("b", datetime(2024, 1, 6), 1)]
    assert index.warehouse.stored("t__keys").count() == 3
    with pytest.raises(ValueError):
        KeyIndex(warehouse, "t", ["k"], 8)


def test_entries_precede_the_rows(spark, warehouse, monkeypatch):
    upsert(warehouse, _rows(spark, ("a", 5, 1)), "t", ["k"], "at", index_buckets=4)
    real = warehouse.overwrite_partitions

    def fails(df, table):
        raise RuntimeError

    monkeypatch.setattr(warehouse, "overwrite_partitions", fails)
    with pytest.raises(RuntimeError):
        upsert(warehouse, _rows(spark, ("a", 3, 2)), "t", ["k"], "at", index_buckets=4)
    monkeypatch.setattr(warehouse, "overwrite_partitions", real)
    for _ in range(2):
        upsert(warehouse, _rows(spark, ("a", 3, 2)), "t", ["k"], "at", index_buckets=4)
        assert _read(warehouse, "t") == [("a", datetime(2024, 1, 3), 2)]
