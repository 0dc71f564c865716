"""Derived business columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.model import ARRIVALS, DEPARTURES, STATUS_OF

UNKNOWN = "UNKNOWN"


def normalised_type(event_type: Column) -> Column:
    """Upper-case event type; a creation becomes ORDER_CREATED."""
    return F.when(event_type == "shipment_created", "ORDER_CREATED").otherwise(F.upper(event_type))


def status_of(norm: Column) -> Column:
    """Shipment status of a normalised type; unlisted types stand for themselves."""
    pairs = [F.lit(text) for pair in STATUS_OF.items() for text in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), norm), norm)


def total_revenue() -> Column:
    return F.expr("coalesce(revenue_amount_vnd, 0) + coalesce(adjustment_amount_vnd, 0)")


def volumetric_gram() -> Column:
    """Length x width x height / 5000 in kg, as whole grams."""
    return F.expr("try_cast(length_cm * width_cm * height_cm / 5000.0D * 1000.0D AS int)")


def route_class(sender_remote: Column, receiver_remote: Column) -> Column:
    """REMOTE if either end is known to be remote, else by province equality."""
    same = F.col("sender_province_id") == F.col("receiver_province_id")
    return (
        F.when(sender_remote | receiver_remote, "REMOTE")
        .when(same, "SAME_PROVINCE")
        .otherwise("INTER_PROVINCE")
    )


def movement(event_type: Column) -> Column:
    """+1 into a facility, -1 out of it, 0 otherwise."""
    return (
        F.when(event_type.isin(*ARRIVALS), 1).when(event_type.isin(*DEPARTURES), -1).otherwise(0)
    )


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 where the quotient is undefined."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 x part / whole, rounded; null where whole is 0."""
    return F.round(F.try_divide(100.0 * part, whole.cast("double")), digits)


def utilisation(count: Column, capacity: Column) -> Column:
    """Share of capacity in percent with two digits, at most 999.99."""
    share = F.least(F.round(count / capacity * 100, 2), F.lit(999.99))
    return F.when(capacity > 0, share).cast("decimal(5,2)")


def fill_unknown(df: DataFrame) -> DataFrame:
    """Null text becomes UNKNOWN, so that group keys are never null."""
    names = [field.name for field in df.schema.fields if field.dataType.simpleString() == "string"]
    return df.fillna(UNKNOWN, names) if names else df


def column_or_null(df: DataFrame, name: str, kind: str = "string") -> Column:
    """The column if the frame has it, else a null of the given type."""
    return (F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name)
