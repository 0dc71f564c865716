"""Row-quality rules and the columns made from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.model import SHIPMENT

# Flag names and limits are fixed values. A null operand raises no flag.
PRESENCE_RULES = {
    "NULL_EVENT_ID": "event_id IS NULL",
    "NULL_EVENT_TIME": "event_time IS NULL",
    "NULL_SHIPMENT_ID": "shipment_id IS NULL",
}
GOODS_RULES = {
    "NON_POSITIVE_WEIGHT": "weight_gram <= 0",
    "NEGATIVE_DECLARED_VALUE": "declared_value_vnd < 0",
    "SLA_DATE_IN_PAST": "try_to_date(sla_committed_date) < to_date(event_time)",
}


def rules_for(topic: str, goods_only_on: str | None = None) -> dict[str, Column]:
    """Rules of a topic. ``goods_only_on`` limits the goods rules to one event type."""
    rules = {name: F.expr(sql) for name, sql in PRESENCE_RULES.items()}
    if topic == SHIPMENT:
        for name, sql in GOODS_RULES.items():
            rule = F.expr(sql)
            if goods_only_on:
                rule = (F.col("event_type") == goods_only_on) & rule
            rules[name] = rule
    return rules


def with_quality(df: DataFrame, topic: str, goods_only_on: str | None = None) -> DataFrame:
    """Add ``dq_flags`` and ``is_valid``; no row is dropped.

    ``is_valid`` repeats the rules instead of counting flags, so a reader that only filters
    on it builds no arrays.
    """
    rules = rules_for(topic, goods_only_on)
    raised = [F.when(rule, F.lit(name)) for name, rule in rules.items()]
    broken = [F.coalesce(rule, F.lit(False)) for rule in rules.values()]
    return df.withColumns(
        {
            "dq_flags": F.array_compact(F.array(*raised)),
            "is_valid": ~reduce(lambda a, b: a | b, broken),
        }
    )


def split_by_quality(
    df: DataFrame, topic: str, goods_only_on: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows that pass, without the flag columns, and rows that do not, with their flags."""
    flagged = with_quality(df, topic, goods_only_on)
    passed = flagged.filter("is_valid").drop("dq_flags", "is_valid")
    return passed, flagged.filter("NOT is_valid").drop("is_valid")
