"""Streams end to end: decoding, late rows, repeats, replays, silence."""

from __future__ import annotations

import json
import os
from dataclasses import replace
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from parcelflow.catalogue.feeds import scan_feed
from parcelflow.catalogue.streams import TRACKER_ROWS, drain, last_journeys, merged_flow, partial_kpis, progress_of, replay_topics, settings, sized_conf, stream_conf, tracker_settings, tracker_topics
from parcelflow.model import FINANCIAL, INTAKE, SHIPMENT, TOPICS, TRACKING, topic_schema
from parcelflow.plans.kpis import KPIS, compute_kpi, merged_kpi
from parcelflow.plans.serving import register_views, shipment_journey, stream_intake_summary, stream_progress_summary
from parcelflow.session import new_scratch, scratch_root, session_conf
from parcelflow.settings import StateThresholds, StreamSettings
from parcelflow.sources.topics import decode, file_topic
from parcelflow.sources.warehouse import Warehouse
from parcelflow.streaming.app import await_streams, start_all, start_partial_kpis, start_tracker
from parcelflow.streaming.progress import ProgressLog, finite
from parcelflow.streaming.sinks import batch_name, folder_append
from parcelflow.streaming.sweep import Run, runs, sweep

LIMITS = StateThresholds(20, 40, 14, 43, 60)
FLOW = KPIS["kpi_facility_flow"]


def stamp(second: int) -> str:
    return f"2024-01-01T{7 + second // 3600:02d}:{second // 60 % 60:02d}:{second % 60:02d}+07:00"


def event(kind, second, sid="S1", **more):
    base = {"event_id": f"{sid}-{kind}-{second}", "event_type": kind, "event_time": stamp(second),
            "processing_time": stamp(second), "schema_version": "v1.0", "shipment_id": sid}
    return base | more


class Feed:
    """Folder of JSON lines, one file per batch."""

    def __init__(self, path):
        self.path, self.count = path, 0

    def put(self, *events):
        lines = [e if isinstance(e, str) else json.dumps(e) for e in events]
        target = self.path / f"{self.count:05d}.json"
        target.write_text("\n".join(lines))
        os.utime(target, (1_700_000_000 + self.count,) * 2)  # files are read in this order
        self.count += 1


@pytest.fixture()
def feed(tmp_path):
    path = tmp_path / "feed"
    path.mkdir()
    return Feed(path)


@pytest.fixture()
def dims(spark):
    return {
        "dim_facility": spark.createDataFrame([("H1", "B1", "P1", 10)], "facility_id string, branch_id string, province_id string, capacity_per_day int"),
        "dim_branch": spark.createDataFrame([("B1", "R1")], "branch_id string, region_id string"),
        "dim_province": spark.createDataFrame([("P1", False)], "province_id string, is_remote boolean"),
        "dim_route": spark.createDataFrame([("RT", "H0", "H1", 2.0)], "route_id string, origin_hub_id string, destination_hub_id string, estimated_duration_hours double"),
        "dim_service_type": spark.createDataFrame([("X", "EXPRESS", 1, 1, 1, 1)], "service_type_id string, speed_tier string, sla_inner_city_days int, sla_same_province_days int, sla_inter_province_days int, sla_remote_days int"),
    }


def stream(spark, feed, topic=TRACKING):
    return decode(file_topic(spark, str(feed.path)), topic)


def test_decoding(spark):
    raw = spark.createDataFrame(
        [
            (0, 1, json.dumps(event("arrived_at_hub", 5, facility_id="H1", sequence_no=3))),
            (0, 2, "not json"),
            (0, 3, json.dumps(event("arrived_at_hub", 5) | {"event_time": "yesterday"})),
        ],
        "kafka_partition int, kafka_offset bigint, raw_value string",
    )
    rows = {r.kafka_offset: r for r in decode(raw, TRACKING).collect()}
    assert str(rows[1].event_time) == "2024-01-01 00:00:05" and rows[1].sequence_no == 3
    assert rows[2].event_id is None and rows[2].event_time is None
    assert rows[3].event_id is not None and rows[3].event_time is None
    assert set(topic_schema(TRACKING).fieldNames()) < set(decode(raw, TRACKING).columns)


def test_settings_follow_the_environment(monkeypatch):
    monkeypatch.setenv("WM_TRACKING", "15 seconds")
    monkeypatch.setenv("STUCK_TIMEOUT_S", "7")
    made = StreamSettings()
    assert made.watermarks[TRACKING] == "15 seconds" and made.watermarks[SHIPMENT] == "60 seconds"
    assert made.thresholds.stuck_s == 7 and made.max_offsets[FINANCIAL] == 8000
    assert made.trigger_args() == {"processingTime": "10 seconds"}


def test_late_rows_are_dropped_and_counted(spark, feed):
    arrival = dict(facility_id="H1")
    feed.put(event("arrived_at_hub", 0, **arrival), event("arrived_at_hub", 600, **arrival))
    feed.put(event("arrived_at_hub", 700, **arrival))
    feed.put(event("departed_hub", 10, **arrival), event("departed_hub", 690, **arrival))
    path = new_scratch(spark, "late")
    log = ProgressLog(spark)
    spark.streams.addListener(log)
    with session_conf(spark, stream_conf(2)):
        query = drain(
            start_partial_kpis(stream(spark, feed), TRACKING, folder_append(path), new_scratch(spark, "c"), settings("5 minutes", "1 minute", "60 seconds"))
        )
    merged = merged_kpi(FLOW, spark.read.parquet(f"{path}/{FLOW.name}"))
    assert merged.agg(F.sum("inbound_count"), F.sum("outbound_count")).first()[:] == (3, 1)
    dropped = sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
    assert dropped == 1
    observed = [p.observedMetrics["intake"] for p in query.recentProgress if "intake" in p.observedMetrics]
    assert sum(o["total"] for o in observed) == 4
    spark.streams.removeListener(log)
    assert finite(float("nan")) == 0.0 and finite(None) == 0.0 and finite(2) == 2.0


def test_replayed_batch_replaces_its_partials(spark):
    append = folder_append(new_scratch(spark, "replay"))
    rows = spark.createDataFrame([("H1", 2)], "facility_id string, n int")
    for batch in (0, 1, 1):
        append(rows, "t", batch_name("/c", "q", batch))
    root = append.__closure__[0].cell_contents
    assert spark.read.parquet(f"{root}/t").agg(F.sum("n")).first()[0] == 4


def run_tracker(spark, feed, dims, watermark="10 seconds"):
    path = new_scratch(spark, "tracker")
    with session_conf(spark, stream_conf(2)):
        drain(
            start_tracker({TRACKING: stream(spark, feed)}, dims, folder_append(path), new_scratch(spark, "c"), settings("5 minutes", "1 minute", watermark, LIMITS))
        )
    return {n: spark.read.parquet(f"{path}/{n}") for n in ("kpi_shipment_journey", "anomaly_alerts")}


def test_tracker_over_many_batches(spark, feed, dims):
    feed.put(
        event("arrived_at_hub", 0, "A", facility_id="H9", route_id="RT"),
        event("picked_up", 0, "B", facility_id="PO"),
        event("delivered", 5, "C", facility_id="PO", attempt_no=1),
    )
    feed.put(event("picked_up", 45, "D", facility_id="PO"), event("departed_hub", 44, "A", facility_id="H9"))
    feed.put(event("arrived_at_hub", 46, "C", facility_id="H1"), event("picked_up", 70, "E"))
    feed.put(event("picked_up", 200, "Z"))
    feed.put(event("picked_up", 400, "Z"))
    tables = run_tracker(spark, feed, dims)
    status = {r.shipment_id: r.status for r in shipment_journey(tables).collect()}
    assert status["B"] == "LOST" and status["C"] == "DELIVERED" and status["A"] == "LOST"
    alerts = {(r.shipment_id, r.anomaly_type) for r in tables["anomaly_alerts"].collect()}
    assert ("A", "ABNORMAL_ROUTE") in alerts and ("A", "LONG_HUB_DWELL") in alerts
    assert {("B", "STUCK_SHIPMENT"), ("B", "SUSPECTED_LOST"), ("D", "STUCK_SHIPMENT")} <= alerts
    assert not any(sid == "C" for sid, _ in alerts)
    stuck = tables["anomaly_alerts"].filter("shipment_id = 'B' AND anomaly_type = 'STUCK_SHIPMENT'")
    assert str(stuck.first().detected_at) == "2024-01-01 00:00:20"
    assert stuck.first().detail == "no event for >20s; last=picked_up"


def test_tracker_blocks_of_any_size_give_the_same_rows_and_stay_over_a_restart(spark, feed, dims):
    def batches():
        names = [f"S{n}" for n in range(12)]
        yield [event("arrived_at_hub", n, name, facility_id=f"H{n % 3}", route_id="RT") for n, name in enumerate(names)]
        yield [event("departed_hub", 30 + n, name, facility_id=f"H{n % 3}") for n, name in enumerate(names) if n % 2]
        yield [event("delivered", 60, name, attempt_no=1) for name in names[:3]] + [event("picked_up", 75, "Z")]
        yield [event("picked_up", 200, "Z"), event("arrived_at_hub", 199, "S0", facility_id="H1")]
        yield [event("picked_up", 400, "Z")]

    def run(blocks):
        folder, path, checkpoint = feed.path.parent / f"b{len(blocks)}-{blocks[0]}", new_scratch(spark, "tracker"), new_scratch(spark, "c")
        folder.mkdir()
        own, states = Feed(folder), []
        with session_conf(spark, stream_conf(2)):
            for number, rows in enumerate(batches()):
                own.put(*rows)
                conf = replace(settings("5 minutes", "1 minute", "10 seconds", LIMITS), tracker_blocks=blocks[number % len(blocks)])
                query = drain(start_tracker({TRACKING: stream(spark, own)}, dims, folder_append(path), checkpoint, conf))
                states.append(query.recentProgress[0].stateOperators[0].numRowsTotal)
        tables = [spark.read.parquet(f"{path}/{n}").drop("ingested_at", "source_batch") for n in ("kpi_shipment_journey", "anomaly_alerts")]
        return [sorted(map(str, t.collect())) for t in tables], max(states)

    one, kept = run([1])
    apart, _ = run([4096])
    restarted, _ = run([5, 3])
    assert one == apart == restarted and all(one)
    # One value and one timer (in two indexes), however many shipments a block has.
    assert kept <= 3


def test_dedup_of_a_large_table_spreads_its_state(spark, tmp_path, monkeypatch):
    from parcelflow.catalogue import streams

    lines = spark.range(300).selectExpr(
        "id % 50 AS l_orderkey", "id AS l_partkey", "1L AS l_suppkey", "cast(id % 2 AS int) AS l_linenumber", "1D AS l_quantity",
        "1D AS l_extendedprice", "0D AS l_discount", "0D AS l_tax", "'A' AS l_returnflag", "'F' AS l_linestatus",
        "TIMESTAMP_NTZ '2000-01-01 00:00:00' AS l_shipdate",
    )
    pq.write_table(lines.toArrow(), str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(streams, "PARTITION_ROWS", 20)
    monkeypatch.setattr(streams, "new_scratch", lambda _, label: str(tmp_path / label))
    out = streams.stream_dedup(spark, str(tmp_path))
    assert sorted(r[:] for r in out.collect()) == sorted((f"T{n}-{n % 2}", 1) for n in range(50))
    assert len([p for p in os.listdir(tmp_path / "checkpoint" / "state" / "0") if p.isdigit()]) == 15


def test_state_partitions_and_blocks_grow_with_the_input():
    few, many, tracker = (
        int(sized_conf(*n)["spark.sql.shuffle.partitions"]) for n in [(1000,), (36_000_000,), (36_000_000, TRACKER_ROWS)]
    )
    assert (few, many, tracker) == (8, 72, 360)
    assert tracker_settings(36_000_000, "60 seconds", LIMITS).tracker_blocks == 36_000_000 // 256


def test_all_streams_together(spark, tmp_path, dims):
    parsed = {}
    feeds = {}
    for topic in TOPICS:
        folder = tmp_path / topic
        folder.mkdir()
        feeds[topic] = Feed(folder)
    feeds[SHIPMENT].put(
        event("shipment_created", 0, pickup_facility_id="H1", partner_id="P", service_type_id="X", weight_gram=5, declared_value_vnd=1, sla_committed_date="2024-01-02"),
        event("shipment_created", 1, "S2", weight_gram=0),
    )
    feeds[TRACKING].put(event("arrived_at_hub", 5, facility_id="H1", route_id="RT"), event("departed_hub", 25, facility_id="H1"), event("delivered", 30, facility_id="H1", attempt_no=1))
    feeds[FINANCIAL].put(event("cod_collected", 31, facility_id="H1", branch_id="B1", cod_amount_vnd=70), event("shipping_fee_confirmed", 2, facility_id="H1", branch_id="B1", revenue_amount_vnd=30))
    for topic in TOPICS:
        parsed[topic] = stream(spark, feeds[topic], topic)
    warehouse = Warehouse(spark, "streams", location=new_scratch(spark, "streams"))
    path = new_scratch(spark, "serving")
    conf = replace(StreamSettings(), available_now=True, thresholds=LIMITS)
    with session_conf(spark, stream_conf(2)):
        queries, log = start_all(warehouse, parsed, dims, folder_append(path), new_scratch(spark, "c"), conf)
        await_streams(queries, log, 2)
        spark.streams.removeListener(log)
    progress = spark.read.parquet(f"{path}/streaming_query_progress")
    assert {r.query_name for r in progress.collect()} >= {"tracker"}
    assert stream_progress_summary({"streaming_query_progress": progress}).count() > 0
    assert {t: warehouse.read(f"raw_{t.split('.')[1]}").count() for t in TOPICS} == {SHIPMENT: 2, TRACKING: 3, FINANCIAL: 2}
    tables = {n: spark.read.parquet(f"{path}/{n}") for n in [*KPIS, "kpi_shipment_journey", "anomaly_alerts"]}
    fin = merged_kpi(KPIS["kpi_financial"], tables["kpi_financial"]).filter("window_start = '2024-01-01 00:00:00'").first()
    assert (fin.total_revenue_vnd, fin.total_cod_vnd, fin.cod_collected_count, fin.cod_committed_count) == (30, 70, 1, 1)
    assert tables["kpi_financial"].filter("facility_id = 'H1'").count() == 5
    volume = tables["kpi_order_volume_partner_service"].collect()
    assert [(r.partner_id, r.service_type_id, r.order_count) for r in volume] == [("P", "X", 1)]
    journey = shipment_journey(tables).filter("shipment_id = 'S1'").first()
    assert (journey.status, journey.total_hub_dwell_s, journey.sla_met) == ("DELIVERED", 20.0, 1)
    assert [r.anomaly_type for r in tables["anomaly_alerts"].collect()] == ["LONG_HUB_DWELL"]
    intake = stream_intake_summary({"streaming_intake_stats": spark.read.parquet(f"{path}/streaming_intake_stats")})
    seen = {r.query_name: (r.input_rows, r.distinct_rows, r.invalid_rows) for r in intake.collect()}
    assert seen["kpi_logistics_shipment_events"] == (2, 2, 1)
    assert seen["kpi_logistics_tracking_events"] == (3, 3, 0)
    register_views(tables, ["v_shipment_status_dist", "v_anomaly_summary"])
    assert spark.sql("SELECT alert_count FROM v_anomaly_summary").first()[0] == 1


def test_lagging_topic_is_kept_or_dropped_by_the_watermark(spark, sf_dir):
    found = {}
    for name, scope, policy in (("kept", "topic", "min"), ("fastest", "topic", "max"), ("union", "union", "min")):
        path = tracker_topics(spark, sf_dir, LIMITS, "60 seconds", scope, policy)
        progress = progress_of(spark, path)
        late = progress.agg({"num_dropped_late_rows": "sum"}).first()[0]
        rows = last_journeys(spark, path).drop("ingested_at", "source_batch")
        found[name] = late, sorted(rows.collect(), key=lambda r: r.shipment_id)
    assert found["kept"][0] == 0 and found["union"][0] > 0
    assert found["fastest"] == found["union"]
    delivered = {name: sum(r.status == "DELIVERED" for r in rows) for name, (_, rows) in found.items()}
    assert delivered["kept"] > delivered["union"]
    # Under min the clock stands at the lagging topic, so the newest day is still open.
    assert any(r.status == "IN_PROCESS" for r in found["kept"][1])


def test_topics_replay_in_steps_of_whole_days(spark):
    fields = "event_id string, event_time timestamp"
    times = ["2024-01-01 05:00:00", "2024-01-02 00:00:00", "2024-01-06 23:59:59", None]
    rows = [(str(i), t and datetime.fromisoformat(t)) for i, t in enumerate(times)]
    feeds = {t: spark.createDataFrame(rows, fields) for t in (SHIPMENT, TRACKING)}
    path, seen = new_scratch(spark, "steps"), []

    def start(parsed):
        both = parsed[SHIPMENT].selectExpr("'s' || event_id AS id").union(parsed[TRACKING].selectExpr("'t' || event_id AS id"))
        return both.writeStream.format("parquet").option("checkpointLocation", f"{path}-c").trigger(availableNow=True).start(path)

    for _ in replay_topics(spark, feeds, {TRACKING: 1}, start):
        seen.append({r.id for r in spark.read.schema("id string").parquet(path).collect()})
    assert seen[0] == {"s0", "s1", "s3"}
    assert seen[1] - seen[0] == {"t0", "t1", "t3"}
    assert seen[2] - seen[1] == {"s2"} and seen[3] - seen[2] == {"t2"}


def test_batch_reported_twice_counts_once(spark):
    row = (datetime(2024, 1, 1), "q", "kpi", 0, 5, 4, 1)
    again = (datetime(2024, 1, 2), *row[1:])
    other = (datetime(2024, 1, 1), "q", "kpi", 1, 2, 2, 0)
    table = spark.createDataFrame([row, again, other], INTAKE).withColumn("ingested_at", F.current_timestamp())
    assert [tuple(r) for r in stream_intake_summary({"streaming_intake_stats": table}).collect()] == [("kpi", 7, 6, 1)]


def test_sweep_loses_more_with_a_tighter_watermark(spark, feed):
    for second in range(0, 600, 120):
        feed.put(event("arrived_at_hub", second, f"S{second}", facility_id="H1"), event("departed_hub", max(0, second - 400), f"L{second}", facility_id="H1"))
    assert len(runs()) == 10
    schema = topic_schema(TRACKING)
    batch = spark.read.schema(schema).json(str(feed.path))
    with session_conf(spark, stream_conf(2)):
        out = sweep(spark, FLOW, lambda: stream(spark, feed), batch, [Run("watermark", "15 seconds"), Run("watermark", "10 minutes")], drain)
        rows = {r.watermark: r for r in out.collect()}
    assert rows["10 minutes"].deviation_pct == 0 and rows["10 minutes"].dropped_late_rows == 0
    assert rows["15 seconds"].dropped_late_rows > 0 and rows["15 seconds"].deviation_pct > 0
    assert compute_kpi(FLOW, batch, "2 minutes", "2 minutes").count() > 0


def test_replay_spans_months_and_keeps_scans_without_time(spark):
    sf = "/root/testdata/sf0.001"
    events = spark.read.parquet(f"{sf}/events.parquet")
    later = events.withColumn("event_id", F.col("event_id") + 1_000_000).withColumn("ts", F.col("ts") + F.expr("INTERVAL 31 DAYS"))
    timeless = events.limit(3).withColumn("event_id", F.col("event_id") + 5_000_000).withColumn("ts", F.lit(None).cast(events.schema["ts"].dataType))
    root = new_scratch(spark, "months")
    events.unionByName(later).unionByName(timeless).write.parquet(f"{root}/events.parquet")
    path = partial_kpis(spark, root, "6 hours", "60 seconds")
    sums = [F.sum(c) for c in ("inbound_count", "outbound_count")]
    once = compute_kpi(FLOW, scan_feed(spark, sf), "6 hours", "6 hours").agg(*sums).first()
    assert merged_flow(spark, path).agg(*sums).first()[:] == (2 * once[0], 2 * once[1])
    seen = progress_of(spark, path).agg(F.sum("num_input_rows"), F.sum("num_dropped_late_rows")).first()
    assert seen[0] == 2 * events.count() + 3


def test_table_without_rows_can_be_read(spark):
    root = new_scratch(spark, "empty")
    append = folder_append(root)
    append(spark.createDataFrame([], "k string, n int"), "t", "a")
    assert spark.read.parquet(f"{root}/t").columns == ["k", "n", "source_batch"]
    append(spark.createDataFrame([("x", 1)], "k string, n int"), "t", "b")
    assert [r[:] for r in spark.read.parquet(f"{root}/t").collect()] == [("x", 1, "b")]


def test_scratch_is_the_shared_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_scratch(spark, "x") != new_scratch(spark, "x")
