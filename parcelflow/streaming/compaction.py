"""Compaction of partial KPI rows that batches left behind.

A table of partial rows has a partition per batch. ``compact`` adds the rows of closed windows up
into one partition; ``partial_rows`` reads the table as the newest generation of the manifest
states it; ``vacuum`` drops what no reader needs.

A generation is one row of the manifest, written as one file, so it counts as a whole or not at
all. For each query run it says up to which batch and window end rows were merged. Such rows are not
read any more, also if their batch is run again later and writes its partition anew. What a failed
compaction has written is in no generation and is replaced by the next one.

Merged partitions have levels: ``fan_in`` of one level become one of the next, so a row is rewritten
once a level. One compaction of a table runs at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from parcelflow.functions.dates import as_timestamp
from parcelflow.operators.windows import merge_partials
from parcelflow.sources.warehouse import Warehouse
from parcelflow.streaming.sinks import BATCH

MANIFEST = "partials_manifest"
_MERGED = "merged-"
_COLUMNS = (
    "closed_before timestamp, runs array<struct<run: string, through: bigint>>, "
    "merged array<struct<name: string, level: int>>, table_name string, generation int"
)


def create_manifest(warehouse: Warehouse) -> None:
    warehouse.create(MANIFEST, _COLUMNS, None, by=["table_name", "generation"])


def _generation(warehouse: Warehouse, table: str, back: int = 0) -> Row | None:
    """The newest generation of a table, or the one ``back`` before it."""
    if not warehouse.exists(MANIFEST):
        return None
    of_table = warehouse.stored(MANIFEST).filter(F.col("table_name") == table)
    newest = of_table.orderBy(F.desc("generation")).limit(back + 1).collect()
    return newest[back] if len(newest) > back else None


def _run() -> Column:
    return F.regexp_extract(BATCH, r"^(.*)-(\d+)$", 1)


def _number() -> Column:
    """Number of the batch; null for a name without one."""
    return F.expr(f"try_cast(nullif(regexp_extract({BATCH}, '^(.*)-([0-9]+)$', 2), '') AS bigint)")


def _is_merged() -> Column:
    return F.col(BATCH).startswith(_MERGED)


def _taken(runs: Sequence[Row]) -> Column:
    """Whether a partition is of a batch that a generation has merged. Grows with restarts from new checkpoints only."""
    tests = [(_run() == r.run) & (_number() <= r.through) for r in runs]
    return F.coalesce(reduce(lambda a, b: a | b, tests, F.lit(False)), F.lit(False))


def _visible(state: Row | None) -> Column:
    if state is None:
        return ~_is_merged()
    closed = F.coalesce(F.col("window_end") <= F.lit(state.closed_before), F.lit(False))
    live = F.col(BATCH).isin([m.name for m in state.merged])
    # An alternative, not a case: its tests of the partition alone reach the scan.
    return (_is_merged() & live) | (~_is_merged() & ~(_taken(state.runs) & closed))


def partial_rows(warehouse: Warehouse, table: str) -> DataFrame:
    """Each partial row once: of batches not merged yet, and of merged partitions."""
    return warehouse.stored(table).filter(_visible(_generation(warehouse, table)))


def _tiers(merged: Sequence[tuple[str, int]], fan_in: int) -> tuple[list[str], int]:
    """Names to rewrite with a new partition, and its level: full levels are taken from the lowest up."""
    taken, level = [], 0
    while True:
        same = [name for name, of in merged if of == level]
        if len(same) + 1 < fan_in:
            return taken, level
        taken, level = taken + same, level + 1


def compact(
    warehouse: Warehouse,
    table: str,
    keys: Sequence[str],
    measures: Sequence[str],
    closed_before: datetime | str,
    fan_in: int = 8,
) -> int | None:
    """Merge the rows of windows that end at or before ``closed_before``; gives the new generation, None if there was nothing.

    ``closed_before`` should lie behind the watermark of the query, so that no window is merged twice for
    late rows; the sums are right wherever it lies. It never goes back. ``fan_in`` is at least 2.
    """
    if fan_in < 2:
        raise ValueError("fan_in must be at least 2")
    create_manifest(warehouse)
    state = _generation(warehouse, table)
    spark = warehouse.spark
    bound = spark.range(1).select(as_timestamp(closed_before)).first()[0]
    if state is not None:
        bound = max(bound, state.closed_before)
    stored = warehouse.stored(table)
    closed = F.col("window_end") <= F.lit(bound)
    # Batches without rows of closed windows count too: their later rows are compared with this bound.
    runs = stored.filter(~_is_merged() & _number().isNotNull()).groupBy(_run().alias("run"))
    through = {r.run: r.through for r in (state.runs if state else [])}
    for row in runs.agg(F.max(_number()).alias("through")).collect():
        through[row.run] = max(row.through, through.get(row.run, -1))
    reached = [Row(run=run, through=last) for run, last in sorted(through.items())]
    fresh = stored.filter(_visible(state) & ~_is_merged() & _taken(reached) & closed)
    if fresh.isEmpty():
        return None

    standing = [(m.name, m.level) for m in (state.merged if state else [])]
    rewritten, level = _tiers(standing, fan_in)
    generation = state.generation + 1 if state else 1
    name = f"{_MERGED}{generation}"
    rows = fresh.unionByName(stored.filter(F.col(BATCH).isin(rewritten))) if rewritten else fresh
    sums = merge_partials(rows, keys, measures).withColumn(BATCH, F.lit(name))
    warehouse.overwrite_partitions(sums, table)

    kept = [m for m in standing if m[0] not in rewritten] + [(name, level)]
    record = (bound, [(r.run, r.through) for r in reached], kept, table, generation)
    warehouse.overwrite_partitions(spark.createDataFrame([record], _COLUMNS).coalesce(1), MANIFEST)
    return generation


def vacuum(warehouse: Warehouse, table: str, grace: int = 1) -> list[str]:
    """Drop partitions that the generation ``grace`` before the newest already hid; gives their names.

    Readers that planned with a newer generation keep their files. Names are as many as batches since the last vacuum.
    """
    state = _generation(warehouse, table, grace)
    newest = _generation(warehouse, table)
    if state is None:
        return []
    live = {m.name for m in newest.merged} | {m.name for m in state.merged}
    upto = newest.generation
    names = []
    parts = warehouse.stored(table).groupBy(BATCH).agg(F.max("window_end").alias("last"), F.max(_taken(state.runs)).alias("taken"))
    for part in parts.collect():
        if part[BATCH].startswith(_MERGED):
            gone = part[BATCH] not in live and int(part[BATCH].removeprefix(_MERGED)) <= upto
        else:
            gone = part.taken and part.last is not None and part.last <= state.closed_before
        if gone:
            warehouse.drop_partition(table, {BATCH: part[BATCH]})
            names.append(part[BATCH])
    return sorted(names)
