"""Event-time windows and the merge of partial windows."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.operators.lookup import input_bytes

_UNIT_S = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


# Windows whose rows are kept together, and bytes of input for a partition of them.
STRETCH_WINDOWS, PARTITION_BYTES = 64, 2 << 20
STRETCH = "_stretch"


def duration_s(text: str) -> int:
    """Seconds of a duration such as '5 minutes'."""
    total = 0
    for count, unit in re.findall(r"(\d+)\s*([a-z]+?)s?\b", text.lower()):
        total += int(count) * _UNIT_S[unit]
    if total <= 0:
        raise ValueError(f"not a duration: {text!r}")
    return total


def flat_window(df: DataFrame) -> DataFrame:
    """Replace the window struct by window_start and window_end, in front."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest
    )


def partitions_for(df: DataFrame) -> int:
    """Shuffle partitions for the rows of a frame: more than the session's where its input is large."""
    size = input_bytes(df) or 0
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The optimizer gives a frame without known size almost the largest long.
    return max(usual, size // PARTITION_BYTES) if size < 1 << 50 else usual


def windowed(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, Column],
    window: str,
    slide: str | None = None,
    ts: str = "event_time",
) -> DataFrame:
    """Aggregate by tumbling or sliding window and keys."""
    span = F.window(ts, window, slide) if slide else F.window(ts, window)
    grouped = df.groupBy(span, *keys).agg(*[m.alias(n) for n, m in measures.items()])
    return flat_window(grouped)


def sliding_sums(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, Column],
    window: str,
    slide: str,
    ts: str = "event_time",
    maxima: Mapping[str, Column] | None = None,
    placed_by: Sequence[str] | None = None,
) -> DataFrame:
    """Sliding windows over sums and counts, and over ``maxima``, in two steps and one shuffle.

    Rows are aggregated once per slide-wide pane, and only the panes are repeated for the
    windows that cover them. Both steps run where the rows of a key and a stretch of time are;
    rows whose windows begin in the stretch before go there too. Partitions grow in number with
    the input, not in size. Needs a window that is a multiple of the slide.

    ``placed_by``, some of the keys, place the rows instead of all keys. The result then keeps the stretch,
    by which ``merge_partials`` adds rows up over the other keys where they are.
    """
    width, step = duration_s(window), duration_s(slide)
    maxima = maxima or {}
    every = {**measures, **maxima}
    if width % step:
        return windowed(df, keys, every, window, slide, ts)
    reach = f"INTERVAL {width - step} SECONDS"

    def stretch(at: Column) -> Column:
        return F.floor(F.unix_seconds(at.cast("timestamp")) / (STRETCH_WINDOWS * width))

    first, last = stretch(F.expr(f"_pane - {reach}")), stretch(F.col("_pane"))
    placed = (
        df.withColumn("_pane", F.window(ts, slide)["start"])
        .withColumn(STRETCH, F.explode(F.sequence(first, last)))
        .repartition(partitions_for(df), *(keys if placed_by is None else placed_by), STRETCH)
    )
    panes = placed.groupBy("_pane", STRETCH, *keys).agg(*[m.alias(n) for n, m in every.items()])
    starts = F.expr(f"sequence(_pane - {reach}, _pane, INTERVAL {step} SECONDS)")
    spread = panes.withColumn("window_start", F.explode(starts))
    return (
        spread.filter(stretch(F.col("window_start")) == F.col(STRETCH))
        .groupBy("window_start", STRETCH, *keys)
        .agg(*[F.sum(n).alias(n) for n in measures], *[F.max(n).alias(n) for n in maxima])
        .withColumn("window_end", F.expr(f"window_start + INTERVAL {width} SECONDS"))
        .select("window_start", "window_end", *keys, *every, *([] if placed_by is None else [STRETCH]))
    )


def merge_partials(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Add up the partial rows of each window and key."""
    stamp = [F.max("ingested_at").alias("ingested_at")] if "ingested_at" in df.columns else []
    # The window fixes the stretch, and rows that were placed by it need no shuffle.
    placed = [STRETCH] if STRETCH in df.columns else []
    return df.groupBy(*keys, *placed).agg(*[F.sum(m).alias(m) for m in measures], *stamp).drop(*placed)
