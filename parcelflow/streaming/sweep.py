"""Runs one KPI stream under several settings and compares each run with the batch result."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.plans.extensions import deviation
from parcelflow.plans.kpis import Kpi, compute_kpi, merged_kpi
from parcelflow.session import new_scratch
from parcelflow.settings import StreamSettings
from parcelflow.streaming.app import start_partial_kpis
from parcelflow.streaming.progress import logged
from parcelflow.streaming.sinks import PROGRESS_TABLE, folder_append, progress_writer

# The settings under comparison, one axis at a time around the baseline.
WATERMARKS = ("15 seconds", "30 seconds", "60 seconds", "120 seconds")
WINDOWS = ("30 seconds", "2 minutes", "5 minutes")
TRIGGERS = ("1 second", "10 seconds", "30 seconds")
BASELINE = {"watermark": "60 seconds", "window": "2 minutes", "trigger": "10 seconds"}


@dataclass(frozen=True)
class Run:
    axis: str
    watermark: str = BASELINE["watermark"]
    window: str = BASELINE["window"]
    trigger: str = BASELINE["trigger"]


def runs() -> list[Run]:
    """Every value of every axis, the others held at the baseline."""
    axes = {"watermark": WATERMARKS, "window": WINDOWS, "trigger": TRIGGERS}
    return [Run(axis, **{axis: value}) for axis, values in axes.items() for value in values]


def sweep(
    spark: SparkSession,
    kpi: Kpi,
    source: Callable[[], DataFrame],
    complete: DataFrame,
    over: Iterable[Run],
    finish: Callable,
    available_now: bool = True,
) -> DataFrame:
    """One row per run: rows dropped as late, deviation from batch, throughput.

    ``source`` opens the replayed stream anew, ``complete`` is the same data as a batch, and
    ``finish`` waits for a query to drain. With ``available_now`` the trigger has no effect; without it
    ``source`` and ``finish`` must bring the rows while the query runs, as ``paced.PacedReplay`` does.
    """
    out = None
    for run in over:
        base = StreamSettings()
        settings = replace(
            base,
            watermarks={topic: run.watermark for topic in base.watermarks},
            window=run.window,
            slide=run.window,
            trigger=run.trigger,
            available_now=available_now,
        )
        path, checkpoint = new_scratch(spark, "sweep"), new_scratch(spark, "checkpoint")
        append = folder_append(path)
        with logged(spark, progress_writer(append, "sweep")) as log:
            query = finish(start_partial_kpis(source(), kpi.topic, append, checkpoint, settings))
            log.settle(query)
        seen = merged_kpi(kpi, spark.read.parquet(f"{path}/{kpi.name}"))
        truth = compute_kpi(kpi, complete, run.window, run.window)
        gaps = deviation(seen, truth, kpi.row_key, list(kpi.measures))
        progress = spark.read.parquet(f"{path}/{PROGRESS_TABLE}").filter(F.col("query_name") == query.name).agg(
            F.count(F.lit(1)).alias("batches"),
            F.count_if(F.col("num_input_rows") > 0).alias("filled_batches"),
            F.sum("num_input_rows").alias("input_rows"),
            F.sum("num_dropped_late_rows").alias("dropped_late_rows"),
            F.max("state_num_rows_total").alias("max_state_rows"),
            F.round(F.avg("batch_duration_ms"), 0).alias("avg_batch_ms"),
        )
        totals = gaps.agg(
            F.sum("realtime").alias("realtime_total"),
            F.sum("batch").alias("batch_total"),
            F.round(
                F.try_divide(100 * F.sum(F.abs(F.col("realtime") - F.col("batch"))), F.sum("batch")), 4
            ).alias("deviation_pct"),
        )
        row = progress.crossJoin(totals).select(
            F.lit(run.axis).alias("axis"),
            F.lit(run.watermark).alias("watermark"),
            F.lit(run.window).alias("window"),
            F.lit(run.trigger).alias("trigger"),
            "*",
        )
        out = row if out is None else out.unionByName(row)
    return out
