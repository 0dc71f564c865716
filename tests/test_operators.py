"""Operators on small frames, hot keys included."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from parcelflow.functions.quality import with_quality
from parcelflow.model import SHIPMENT, TRACKING
from parcelflow.operators.dedup import first_per_key, latest_per_key
from parcelflow.operators.lookup import Lookup, apply_lookups, fits_broadcast, lookup
from parcelflow.operators.ordering import carry_forward
from parcelflow.operators.upsert import merge_rows, unique_source
from parcelflow.operators.windows import duration_s, sliding_sums, windowed
from parcelflow.plans import facts
from parcelflow.session import session_conf
from parcelflow.sources.dimensions import calendar


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(spark, rows=3000):
    """A third of the rows under one key."""
    return spark.range(rows).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 997).alias("t"),
        F.when(F.col("id") % 4 == 0, F.col("id")).alias("v"),
    )


def test_carry_forward_equals_a_plain_window(spark):
    df = skewed(spark)
    plain = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("before", F.last("v", ignorenulls=True).over(plain))
    got = carry_forward(df, "k", ["t", "id"], {"before": F.col("v")}, F.date_trunc("day", "t"))
    assert got.count() == 3000
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_carry_forward_partitions_by_key_and_bucket(spark):
    got = carry_forward(skewed(spark), "k", ["t", "id"], {"before": F.col("v")}, F.date_trunc("day", "t"))
    assert "hashpartitioning(k" in plan(got) and "_bucket" in plan(got)


def test_lookup_paths_agree(spark):
    fact = skewed(spark)
    dim = fact.select("k").distinct().filter("k <> 'k1'").withColumn("d", F.length("k"))
    want = fact.join(dim, "k", "left")
    assert "BroadcastHashJoin" in plan(lookup(fact, dim, ["k"]))
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        shuffled = lookup(fact, dim, ["k"], limit=0)
        assert "BroadcastHashJoin" not in plan(shuffled)
        assert shuffled.exceptAll(want).count() == 0
        with session_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
            salted = lookup(fact, dim, ["k"], limit=0, salts=4)
            assert "_salt" in plan(salted)
            assert sorted(salted.columns) == sorted(want.columns)
            assert salted.select(want.columns).exceptAll(want).count() == 0
            assert salted.count() == fact.count()


def test_broadcast_needs_a_known_small_size(spark, sf_dir):
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    assert fits_broadcast(lineitem) and not fits_broadcast(lineitem, limit=1000)


def test_absent_lookup_key_is_skipped(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert apply_lookups(df, {}, [Lookup("dim", "b", "b", {})]).columns == ["a"]


def test_dedup_limits_groups_before_the_shuffle(spark):
    df = skewed(spark)
    first = first_per_key(df, ["k"], ["t"])
    assert plan(first).count("WindowGroupLimit") == 2
    assert first.filter("k = 'hot'").first()["id"] == 0
    assert latest_per_key(df, ["k"], ["t"]).filter("k = 'hot'").first()["id"] == 2997


def test_sliding_panes_equal_plain_sliding_windows(spark):
    df = skewed(spark)
    measures = {"n": F.count(F.lit(1)), "s": F.sum("v")}
    args = (df, ["k"], measures, "6 hours", "2 hours", "t")
    want = windowed(*args)
    got = sliding_sums(*args)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert duration_s("1 hour 30 minutes") == 5400
    with pytest.raises(ValueError):
        duration_s("soon")


def test_sliding_windows_take_one_shuffle_whose_partitions_grow_with_the_input(spark, monkeypatch, tmp_path):
    from parcelflow.operators import windows

    hours = spark.range(4000).selectExpr(
        "concat('k', id % 3) AS k", "id % 5 AS part", "timestamp_seconds(-9000000 + id * 7919) AS t", "id AS v"
    )
    empty = "k string, part bigint, t timestamp, v bigint"
    holes = spark.createDataFrame([(None, 1, None, 5), ("k1", None, None, 5), (None, None, datetime(2024, 1, 1), 9)], empty)
    hours.unionByName(holes).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    measures = {"n": F.count(F.lit(1)), "s": F.sum("v")}
    want = windowed(rows, ["k"], measures, "6 hours", "2 hours", "t")
    got = sliding_sums(rows, ["k"], measures, "6 hours", "2 hours", "t")
    parts = sliding_sums(rows, ["k", "part"], measures, "6 hours", "2 hours", "t", placed_by=["k"])
    merged = windows.merge_partials(parts, ["window_start", "window_end", "k"], ["n", "s"])
    for made in (got, merged):
        assert made.exceptAll(want).count() == 0 and want.exceptAll(made).count() == 0
        assert plan(made).count("Exchange hashpartitioning") == 1
    monkeypatch.setattr(windows, "PARTITION_BYTES", 1000)
    assert windows.partitions_for(rows) > int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_merge_rows_updates_inserts_and_keeps(spark):
    ddl = "k string, updated_at int, v string"
    target = spark.createDataFrame([("a", 5, "old"), ("b", 9, "old"), ("c", 1, "old")], ddl)
    source = spark.createDataFrame([("a", 7, "new"), ("b", 3, "new"), ("d", 1, "new")], ddl)
    plain = {r.k: r.v for r in merge_rows(target, source, ["k"]).collect()}
    assert plain == {"a": "new", "b": "new", "c": "old", "d": "new"}
    rules = {"v": facts.from_newer("v", "updated_at"), "updated_at": facts.latest("updated_at")}
    ruled = {r.k: (r.updated_at, r.v) for r in merge_rows(target, source, ["k"], rules).collect()}
    assert ruled == {"a": (7, "new"), "b": (9, "old"), "c": (1, "old"), "d": (1, "new")}


def test_repeated_source_key_is_refused(spark):
    source = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    with pytest.raises(Exception, match="repeats a key"):
        unique_source(source, ["k"]).collect()


def test_quality_flags_ignore_null_operands(spark):
    ddl = (
        "event_id string, event_time timestamp, shipment_id string, weight_gram int, "
        "declared_value_vnd bigint, sla_committed_date string"
    )
    from datetime import datetime as dt

    at = dt(2024, 1, 5, 10)
    rows = [
        ("1", at, "s", None, None, None),
        ("2", at, "s", 0, -1, "2024-01-04"),
        ("3", at, "s", 1, 0, "2024-01-05"),
        (None, None, None, -1, 5, "2024-01-06"),
        ("5", at, "s", 1, 1, "not a date"),
    ]
    df = spark.createDataFrame(rows, ddl)
    flags = [r.dq_flags for r in with_quality(df, SHIPMENT).collect()]
    assert flags == [
        [],
        ["NON_POSITIVE_WEIGHT", "NEGATIVE_DECLARED_VALUE", "SLA_DATE_IN_PAST"],
        [],
        ["NULL_EVENT_ID", "NULL_EVENT_TIME", "NULL_SHIPMENT_ID", "NON_POSITIVE_WEIGHT"],
        [],
    ]
    assert with_quality(df, TRACKING).filter("is_valid").count() == 4


def test_calendar(spark):
    days = {r.full_date: r for r in calendar(spark, "2024-04-26", "2024-05-02").collect()}
    assert len(days) == 7
    holiday = days["2024-04-30"]
    assert (holiday.day_of_week, holiday.day_name, holiday.is_working_day) == (2, "Tuesday", False)
    assert days["2024-04-27"].is_weekend and days["2024-04-26"].is_working_day
    assert (days["2024-05-02"].date_id, days["2024-05-02"].quarter_no) == (20240502, 2)


def test_presence_rolls_forward(spark):
    rows = [("F", "a", "arrived_at_hub"), ("F", "a", "departed_hub"), ("F", "b", "arrived_at_hub"),
            ("G", "a", "arrived_at_hub"), ("G", "a", "failed_delivery"), ("G", "c", "departed_hub")]
    ddl = "facility_id string, shipment_id string, event_type string"
    whole = facts.net_presence(spark.createDataFrame(rows, ddl))
    before = facts.net_presence(spark.createDataFrame(rows[:3], ddl))
    after = facts.net_presence(spark.createDataFrame(rows[3:], ddl), before)
    assert sorted(after.collect()) == sorted(whole.collect())
    dims = {"dim_facility": spark.createDataFrame([("F", 1), ("G", 3)], "facility_id string, capacity_per_day int")}
    out = {r.facility_id: r for r in facts.fact_hub_inventory(whole, dims, "2024-01-01").collect()}
    assert {k: (r.total_shipments, str(r.capacity_utilization_pct)) for k, r in out.items()} == {
        "F": (1, "100.00"),
        "G": (1, "33.33"),
    }


def test_rows_with_null_keys_are_updated_not_repeated(spark):
    schema = "shipment_id string, attempt_no int, result string"
    rows = spark.createDataFrame([("S1", None, "a"), ("S2", 1, "b"), (None, None, "c")], schema)
    once = merge_rows(rows, rows, ["shipment_id", "attempt_no"])
    again = merge_rows(once, rows, ["shipment_id", "attempt_no"])
    assert sorted(map(str, again.collect())) == sorted(map(str, rows.collect()))
