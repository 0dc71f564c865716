"""Keyed upsert: update rows that match, insert the others."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.operators.keyindex import KeyIndex
from parcelflow.sources.warehouse import ARRIVED, DAY, Warehouse, in_partitions

# A rule gives the new value of one column from (target, source) column accessors.
Accessor = Callable[[str], Column]
Rule = Callable[[Accessor, Accessor], Column]


def first_known(name: str) -> Rule:
    return lambda t, s: F.coalesce(t(name), s(name))


def earliest(name: str) -> Rule:
    return lambda t, s: F.least(t(name), s(name))


def latest(name: str) -> Rule:
    return lambda t, s: F.greatest(t(name), s(name))


def either(name: str) -> Rule:
    return lambda t, s: t(name) | s(name)


def from_newer(name: str, stamp: str) -> Rule:
    """Source value unless the target row is newer; a target without stamp stays."""
    return lambda t, s: F.when(s(stamp) >= t(stamp), s(name)).otherwise(t(name))


def from_source(name: str) -> Rule:
    return lambda t, s: s(name)


def unique_source(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The frame, failing at run time if a key repeats. Shares the join's shuffle and sort."""
    copies = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    message = F.lit(f"upsert source repeats a key of {list(keys)}")
    checked = F.when(copies > 1, F.raise_error(message)).otherwise(F.lit(True))
    return source.withColumn("_unique", checked.cast("boolean")).filter("_unique").drop("_unique")


def _null_safe(keys: Sequence[str]) -> list[Column]:
    """A null in a key is a value like any other, so a rerun finds the rows it wrote."""
    return [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]


def _value(name: str, keys: Sequence[str], rules: Mapping[str, Rule]) -> Column:
    """New value of a column of joined rows."""

    def of_t(name: str) -> Column:
        return F.col(f"t.{name}")

    def of_s(name: str) -> Column:
        return F.col(f"s.{name}")

    rule = from_source(name) if name in keys else rules.get(name, from_source(name))
    return (
        F.when(F.col("_in_target").isNull(), of_s(name))
        .when(F.col("_in_source").isNull(), of_t(name))
        .otherwise(rule(of_t, of_s))
        .alias(name)
    )


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    rules: Mapping[str, Rule] | None = None,
) -> DataFrame:
    """Full result of the upsert: updated, inserted and untouched rows."""
    t = target.withColumn("_in_target", F.lit(True)).alias("t")
    s = source.withColumn("_in_source", F.lit(True)).alias("s")
    rows = t.join(s, _null_safe(keys), "full_outer")
    return rows.select(*[_value(c, keys, rules or {}) for c in target.columns])


def _merged(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[Column]) -> DataFrame:
    """Columns of the rows of both sides, joined as in ``merge_rows``.

    Rows without a null in a key are joined by plain equality, which a source that is made by its keys
    (dedup, aggregation) needs no second shuffle for; the null-safe one hashes other expressions. A row with a
    null in a key can match only such rows.
    """
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    plain = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    t, s = target.withColumn("_in_target", F.lit(True)), source.withColumn("_in_source", F.lit(True))

    def joined(test: Column, match: list[Column]) -> DataFrame:
        return t.filter(test).alias("t").join(s.filter(test).alias("s"), match, "full_outer").select(*columns)

    return joined(complete, plain).unionAll(joined(~complete, _null_safe(keys)))


def upsert(
    warehouse: Warehouse,
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    ts: str,
    rules: Mapping[str, Rule] | None = None,
    by: Sequence[str] = (),
    key_fixes_partition: bool = False,
    index_buckets: int | None = None,
) -> None:
    """Upsert a frame into a table, creating the table from the frame if needed.

    Only partitions that hold a match or take rows in are read in whole and rewritten. ``key_fixes_partition``
    says that a key never changes its partition (an event keeps its time), so that matches are sought in
    the partitions of the run only. ``index_buckets`` keeps an index of the keys
    in so many buckets, and the search reads the buckets of the incoming keys only; then every
    writer of the table must give it. One writer per table at a time.

    Without an index nothing is staged: the frame is read twice, first by its keys, times and partitions only, so these
    must be the same each time (no clock in them).
    """
    if not warehouse.exists(table):
        warehouse.like(source, table, ts, by)
    if warehouse.native_merge:
        _merge_in_place(warehouse, source, table, keys, rules or {})
        return

    if index_buckets:
        _upsert_indexed(warehouse, source, table, keys, ts, rules, KeyIndex(warehouse, table, keys, index_buckets))
        return
    stored, fresh = warehouse.stored(table), unique_source(source, keys)
    if stored.isEmpty():
        warehouse.overwrite_partitions(warehouse.with_day(fresh, ts), table, spread=not _coalesced(warehouse))
        return

    parts, rules = warehouse.partition_columns(table), rules or {}
    target = stored
    if key_fixes_partition:
        # A match has the same day and type, but may have arrived on any day.
        fixed = [c for c in parts if c != ARRIVED]
        days = warehouse.with_day(source, ts).select(*fixed).distinct().collect()
        target = stored.filter(in_partitions(fixed, [tuple(row) for row in days]))
    left, written, kept = _moves(warehouse, table, target, fresh, parts, keys, ts, rules)
    affected = stored.filter(in_partitions(parts, sorted(left | written, key=str))).drop(DAY)
    merged = _merged(affected, fresh, keys, [_value(c, keys, rules) for c in affected.columns])
    warehouse.overwrite_partitions(warehouse.with_day(merged, ts), table, spread=not _coalesced(warehouse))
    for place in left - written - kept:
        warehouse.drop_partition(table, dict(zip(parts, place)))


def _coalesced(warehouse: Warehouse) -> bool:
    """Whether the planner joins small shuffle partitions.

    Rows come by a hash of their key, an even share of each partition to every task. With tasks in proportion to the rows they can be
    written as they are; otherwise each of a fixed number of tasks would write a small file per partition.
    """
    names = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.coalescePartitions.enabled")
    return all(warehouse.spark.conf.get(name) == "true" for name in names)


def _moves(warehouse, table, target, fresh, parts, keys, ts, rules) -> tuple[set, set, set]:
    """Partitions that hold a match, those that rows of the source end in, and those where other rows stay.

    Reads keys, partitions and what the rules of these take. Bounded by days x event types, not by rows.
    """
    names = [c for c in parts if c != DAY]
    # The day of a row as the merge will make it.
    ends = [*[_value(c, keys, rules) for c in names], *([warehouse.day_of(_value(ts, keys, rules)).alias(DAY)] if DAY in parts else [])]
    begins = [F.col(f"t.{c}").alias(f"_from_{c}") for c in parts]
    flags = [F.col(c).isNotNull().alias(c) for c in ("_in_target", "_in_source")]
    rows = _merged(target, fresh, keys, [*ends, *begins, *flags]).distinct().collect()
    place = lambda row, prefix="": tuple(row[f"{prefix}{c}"] for c in parts)
    left = {place(r, "_from_") for r in rows if r["_in_target"] and r["_in_source"]}
    written = {place(r) for r in rows if r["_in_source"]}
    others = [r for r in rows if not r["_in_source"]]
    strays = {place(r) for r in others if place(r) != place(r, "_from_") and place(r, "_from_") in left | written}
    if strays:
        raise ValueError(f"{table}: rows left the partitions that were read: {sorted(strays, key=str)[:3]}")
    return left, written, {place(r) for r in others}


def _upsert_indexed(warehouse: Warehouse, source: DataFrame, table: str, keys, ts: str, rules, index: KeyIndex) -> None:
    """The same by the index, which must know the new places of keys before the table is written: both sides are staged."""
    spark, parts, stored = warehouse.spark, warehouse.partition_columns(table), warehouse.stored(table)
    incoming, outgoing = f"{table}__incoming", f"{table}__outgoing"
    warehouse.replace(incoming, warehouse.with_day(source, ts))
    fresh = spark.table(warehouse.name(incoming))
    touched = fresh.select(*parts).unionByName(index.places(fresh))
    # Bounded by days x event types, not by rows.
    places = [tuple(row) for row in touched.distinct().collect()]

    affected = stored.filter(in_partitions(parts, places)).drop(DAY)
    merged = merge_rows(affected, unique_source(fresh.drop(DAY), keys), keys, rules)
    warehouse.replace(outgoing, warehouse.with_day(merged, ts))
    result = spark.table(warehouse.name(outgoing))

    written = {tuple(row) for row in result.select(*parts).distinct().collect()}
    strays = written - set(places)
    if strays:
        raise ValueError(f"{table}: rows left the partitions that were read: {sorted(strays)[:3]}")
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    index.add(result.alias("r").join(fresh.select(*keys).alias("s"), same, "left_semi"))
    warehouse.overwrite_partitions(result, table)
    for place in set(places) - written:
        warehouse.drop_partition(table, dict(zip(parts, place)))
    warehouse.drop(incoming)
    warehouse.drop(outgoing)


def _merge_in_place(warehouse, source, table, keys, rules) -> None:
    """MERGE on a catalog that has it."""
    name = warehouse.name(table)

    def of_t(column: str) -> Column:
        return F.col(f"{name}.{column}")

    def of_s(column: str) -> Column:
        return F.col(f"s.{column}")

    condition = F.lit(True)
    for key in keys:
        condition = condition & of_t(key).eqNullSafe(of_s(key))
    values = {c: rules.get(c, from_source(c))(of_t, of_s) for c in source.columns if c not in keys}
    merge = source.alias("s").mergeInto(name, condition)
    merge.whenMatched().update(values).whenNotMatched().insertAll().merge()
