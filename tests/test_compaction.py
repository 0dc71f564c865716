"""Compaction of partial rows: equal sums, fewer partitions, no way back for a batch run again."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from parcelflow.operators.windows import merge_partials
from parcelflow.session import new_scratch, session_conf
from parcelflow.sources.warehouse import Warehouse
from parcelflow.streaming import compaction
from parcelflow.streaming.compaction import compact, partial_rows, vacuum
from parcelflow.streaming.sinks import BATCH, table_append

START = datetime(2024, 1, 1)
KEYS, TABLE = ["window_start", "window_end", "k"], "p"


class Partials:
    def __init__(self, spark):
        name = "c" + uuid.uuid4().hex[:8]
        self.spark, self.warehouse = spark, Warehouse(spark, name, location=new_scratch(spark, name))
        self.append = table_append(self.warehouse)

    def put(self, batch, *rows, run="r"):
        """Rows of (hour of the window, key, count)."""
        at = [(START + timedelta(hours=h), START + timedelta(hours=h + 1), k, n) for h, k, n in rows]
        df = self.spark.createDataFrame(at, "window_start timestamp, window_end timestamp, k string, n bigint")
        self.append(df.withColumn("ingested_at", F.lit(START)), TABLE, f"{run}-{batch}")

    def compact(self, hour, **more):
        return compact(self.warehouse, TABLE, KEYS, ["n"], START + timedelta(hours=hour), **more)

    def sums(self):
        rows = merge_partials(partial_rows(self.warehouse, TABLE), KEYS, ["n"]).collect()
        return sorted((((r.window_start - START).seconds // 3600, r.k, r.n) for r in rows), key=str)

    def stored(self):
        return {r[0] for r in self.warehouse.stored(TABLE).select(BATCH).distinct().collect()}


@pytest.fixture()
def partials(spark):
    return Partials(spark)


def test_closed_windows_are_merged_once_and_open_ones_stay(partials):
    partials.put(0, (0, "a", 1), (0, None, 1), (5, "a", 1))
    partials.put(1, (0, "a", 2), (1, "b", 4))
    before = partials.sums()
    assert before == [(0, "a", 3), (0, None, 1), (1, "b", 4), (5, "a", 1)]
    assert partials.compact(2) == 1
    assert partials.sums() == before
    # Batch 1 lies in closed windows only; it goes when no reader of the generation before can need it.
    assert vacuum(partials.warehouse, TABLE) == []
    assert vacuum(partials.warehouse, TABLE, grace=0) == ["r-1"]
    assert partials.sums() == before and partials.stored() == {"r-0", "merged-1"}
    assert partials.compact(2) is None


def test_batch_run_again_brings_nothing_back(partials):
    partials.put(0, (0, "a", 1), (5, "a", 1))
    partials.put(1, (0, "a", 2))
    before = partials.sums()
    partials.compact(2)
    partials.put(1, (0, "a", 2))
    partials.put(0, (0, "a", 1), (5, "a", 1))
    assert partials.sums() == before
    vacuum(partials.warehouse, TABLE, grace=0)
    partials.put(1, (0, "a", 2))
    assert partials.compact(9) == 2
    assert partials.sums() == before


def test_late_rows_of_a_new_batch_and_of_another_run_count(partials):
    partials.put(0, (0, "a", 1))
    partials.compact(2)
    partials.put(1, (0, "a", 10))
    partials.put(0, (0, "a", 100), run="other-run")
    assert partials.sums() == [(0, "a", 111)]
    assert partials.compact(1) == 2
    assert partials.sums() == [(0, "a", 111)]
    state = compaction._generation(partials.warehouse, TABLE)
    assert state.closed_before == START + timedelta(hours=2)
    assert [(r.run, r.through) for r in state.runs] == [("other-run", 0), ("r", 1)]


def test_failed_compaction_is_not_seen(partials, monkeypatch):
    partials.put(0, (0, "a", 1))
    partials.put(1, (0, "a", 2))
    real = partials.warehouse.overwrite_partitions

    def fails(df, table):
        if table == compaction.MANIFEST:
            raise RuntimeError
        real(df, table)

    monkeypatch.setattr(partials.warehouse, "overwrite_partitions", fails)
    with pytest.raises(RuntimeError):
        partials.compact(2)
    monkeypatch.undo()
    assert "merged-1" in partials.stored() and partials.sums() == [(0, "a", 3)]
    partials.put(2, (0, "b", 5))
    assert partials.compact(2) == 1
    assert partials.sums() == [(0, "a", 3), (0, "b", 5)]


def test_levels_keep_partitions_few(partials):
    for batch in range(9):
        partials.put(batch, (batch % 3, "a", 1))
        partials.compact(9, fan_in=3)
        vacuum(partials.warehouse, TABLE, grace=0)
        state = compaction._generation(partials.warehouse, TABLE)
        assert len(state.merged) <= 2 * 2
        assert partials.stored() == {m.name for m in state.merged}
    assert [(m.name, m.level) for m in state.merged] == [("merged-9", 2)]
    assert partials.sums() == [(0, "a", 3), (1, "a", 3), (2, "a", 3)]


def test_scan_skips_merged_partitions_of_older_generations(partials):
    for batch in range(2):
        partials.put(batch, (0, "a", 1))
        partials.compact(2, fan_in=2)
    assert {"merged-1", "merged-2"} <= partials.stored()
    plan = partial_rows(partials.warehouse, TABLE)._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "merged-2" in filters and "merged-1" not in filters
    assert partials.sums() == [(0, "a", 2)]


def test_nothing_to_merge_and_bad_parameters(partials):
    partials.put(0)
    assert partials.compact(2) is None and partials.sums() == []
    assert vacuum(partials.warehouse, TABLE) == []
    with pytest.raises(ValueError):
        partials.compact(2, fan_in=1)


def test_a_session_that_overwrites_whole_tables_by_default_keeps_other_partitions(spark, partials):
    with session_conf(spark, {"spark.sql.sources.partitionOverwriteMode": "static"}):
        partials.put(0, (0, "a", 1), (1, "b", 2))
        partials.put(1, (0, "a", 4))
        assert partials.stored() == {"r-0", "r-1"}
        partials.compact(1, fan_in=2)
        partials.put(2, (0, "a", 8))
        partials.compact(2, fan_in=2)
        assert partials.sums() == [(0, "a", 13), (1, "b", 2)]
