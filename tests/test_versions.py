"""Dimensions that change between batches, and quantile sketches in partial rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from parcelflow.model import TRACKING
from parcelflow.operators.sketches import merged, quantile, rank_error, sketch
from parcelflow.plans.serving import held_ranks, latency_merged, latency_parts
from parcelflow.session import new_scratch
from parcelflow.sources.versions import DimensionVersions
from parcelflow.streaming.sinks import enriched_writer, folder_append


@pytest.fixture()
def versions(spark):
    return DimensionVersions(spark, new_scratch(spark, "versions"))


def places(spark, branch):
    return spark.createDataFrame([("F1", branch, "P1")], "facility_id string, branch_id string, province_id string")


def routes(spark):
    return spark.createDataFrame(
        [("RT1", "F1", "F2", None)],
        "route_id string, origin_hub_id string, destination_hub_id string, estimated_duration_hours decimal(5,2)",
    )


def test_a_version_keeps_tables_that_did_not_change(spark, versions):
    assert versions.newest() == 0
    assert versions.publish({"dim_facility": places(spark, "B1"), "dim_route": routes(spark)}) == 1
    assert versions.publish({"dim_facility": places(spark, "B2")}) == 2
    assert versions.newest() == 2
    assert versions.read(1)["dim_facility"].first()["branch_id"] == "B1"
    assert versions.read(2)["dim_facility"].first()["branch_id"] == "B2"
    assert versions.read(2)["dim_route"].first()["destination_hub_id"] == "F2"
    with pytest.raises(ValueError, match="no version 3"):
        versions.read(3)


def test_tables_without_a_statement_are_no_version(spark, versions):
    versions.publish({"dim_facility": places(spark, "B1")})
    places(spark, "B9").write.parquet(f"{versions.root}/tables/dim_facility-unfinished")
    assert versions.newest() == 1
    assert versions.read(1)["dim_facility"].first()["branch_id"] == "B1"


def test_a_batch_run_again_reads_the_version_it_read_first(spark, versions):
    versions.publish({"dim_facility": places(spark, "B1"), "dim_route": routes(spark)})
    path = new_scratch(spark, "enriched")
    write = enriched_writer(versions, TRACKING, "enriched", folder_append(path), lambda n: f"run-{n}")
    batch = spark.createDataFrame(
        [("E1", "arrived_at_hub", "F1", "RT1"), ("E2", "departed_hub", "F7", None), ("E3", None, None, None)],
        "event_id string, event_type string, facility_id string, route_id string",
    )
    write(batch, 0)
    versions.publish({"dim_facility": places(spark, "B2")})
    write(batch, 0)
    write(batch, 1)
    rows = {(r["source_batch"], r["event_id"]): r for r in spark.read.parquet(f"{path}/enriched").collect()}
    assert len(rows) == 6
    assert rows["run-0", "E1"]["branch_id"] == "B1" and rows["run-0", "E1"]["dim_version"] == 1
    assert rows["run-1", "E1"]["branch_id"] == "B2" and rows["run-1", "E1"]["dim_version"] == 2
    assert rows["run-1", "E1"]["destination_hub_id"] == "F2"
    assert rows["run-1", "E2"]["branch_id"] is None and rows["run-1", "E3"]["event_type_norm"] is None


@pytest.mark.parametrize("shape", ["even", "hot", "reversed"])
def test_merged_sketches_stay_within_the_stated_rank_error(spark, shape):
    n = 50_000
    value = {"even": F.col("id"), "hot": F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")), "reversed": n - F.col("id")}
    rows = spark.range(n).withColumn("v", value[shape].cast("bigint"))
    parts = rows.groupBy(F.expr("id % 40").alias("part")).agg(sketch(F.col("v")).alias("s"))
    whole = parts.agg(merged(F.col("s")).alias("s"))
    for share in (0.05, 0.5, 0.95):
        found = whole.select(quantile("s", share)).first()[0]
        below, upto = rows.filter(F.col("v") < found).count(), rows.filter(F.col("v") <= found).count()
        assert below / n - 2 * rank_error() <= share <= upto / n + 2 * rank_error()


def test_latency_out_of_parts_equals_the_exact_figures_of_few_rows(spark):
    data = [("a", day, lag) for day in range(3) for lag in (1, 2, 3, None)] + [("b", 0, None)]
    rows = spark.createDataFrame(data, "kpi_name string, day int, pipeline_latency_s bigint").withColumn(
        "last_ingested_at", F.timestamp_seconds(F.col("day") * 60)
    )
    parts = latency_parts(rows, ["kpi_name", "day"], "last_ingested_at")
    assert parts.count() == 4
    out = latency_merged(parts, ["kpi_name"], "window_count", "1970-01-01 00:10:00")
    got = {r["kpi_name"]: r for r in out.collect()}
    a, b = got["a"], got["b"]
    assert (a["window_count"], a["avg_latency_s"], a["p50_latency_s"], a["max_latency_s"], a["data_age_s"]) == (12, 2.0, 2, 3, 480)
    assert (b["window_count"], b["avg_latency_s"], b["p50_latency_s"], b["max_latency_s"]) == (1, None, None, None)
    held = {r["kpi_name"]: r for r in held_ranks(rows, out, ["kpi_name"]).collect()}
    assert held["a"]["p50_within"] and held["a"]["p95_within"]


def test_no_rows_give_no_figures(spark):
    none = spark.createDataFrame([], "kpi_name string, pipeline_latency_s bigint, last_ingested_at timestamp")
    parts = latency_parts(none, ["kpi_name"], "last_ingested_at")
    assert latency_merged(parts, ["kpi_name"], "window_count").count() == 0
