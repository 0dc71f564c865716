"""Dimension tables: load, build, flatten; and the calendar."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow.functions.measures import UNKNOWN
from parcelflow.operators.lookup import Lookup, apply_lookups

STREAM_DIMS = ("dim_facility", "dim_branch", "dim_province", "dim_service_type", "dim_route")

# Month, day and name of the public holidays.
HOLIDAYS = [
    (1, 1, "Tết Dương lịch"),
    (4, 30, "Giải phóng miền Nam"),
    (5, 1, "Quốc tế Lao động"),
    (9, 2, "Quốc khánh"),
]


def load_dimensions(warehouse, names: Sequence[str] = STREAM_DIMS) -> dict[str, DataFrame]:
    return {name: warehouse.read(name) for name in names}


def read_source(
    spark: SparkSession, fmt: str, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """Batch file scan. CSV has a header; types are inferred only without a schema."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.options(header=True, inferSchema=schema is None)
    return reader.load(path)


def build_dimensions(warehouse, specs: Sequence[Mapping]) -> None:
    """Create or replace one table per spec: source_table, source_format, source_path."""
    for spec in specs:
        frame = read_source(
            warehouse.spark, spec["source_format"], spec["source_path"], spec.get("schema")
        )
        warehouse.replace(spec["source_table"], frame)


def flat_facilities(dims: Mapping[str, DataFrame]) -> DataFrame:
    """Facility with branch and region names; what is missing reads UNKNOWN."""
    joined = apply_lookups(
        dims["dim_facility"],
        dims,
        [
            Lookup(
                "dim_branch",
                "branch_id",
                "branch_id",
                {"branch_name": "branch_name", "region_id": "region_id"},
            ),
            Lookup("dim_region", "region_id", "region_id", {"region_name": "region_name"}),
        ],
    )
    filled = joined.fillna(UNKNOWN, ["branch_name", "region_id", "region_name"])
    return filled.select(
        "facility_id",
        "facility_name",
        "facility_type",
        "branch_id",
        "branch_name",
        "region_id",
        "region_name",
        "province_id",
        "capacity_per_day",
    )


def calendar_columns(days: DataFrame, day: str = "full_date") -> DataFrame:
    """The 13 calendar columns of a frame of dates."""
    date = F.col(day)
    holiday = F.coalesce(
        *[F.when((F.month(date) == m) & (F.day(date) == d), F.lit(name)) for m, d, name in HOLIDAYS]
    )
    weekend = F.weekday(date) >= 5
    return days.select(
        F.date_format(date, "yyyyMMdd").cast("int").alias("date_id"),
        F.date_format(date, "yyyy-MM-dd").alias("full_date"),
        (F.weekday(date) + 1).alias("day_of_week"),
        F.date_format(date, "EEEE").alias("day_name"),
        F.day(date).alias("day_of_month"),
        F.month(date).alias("month_no"),
        F.date_format(date, "MMMM").alias("month_name"),
        F.year(date).alias("year_no"),
        F.quarter(date).alias("quarter_no"),
        weekend.alias("is_weekend"),
        holiday.isNotNull().alias("is_holiday"),
        holiday.alias("holiday_name"),
        (~weekend & holiday.isNull()).alias("is_working_day"),
    )


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Calendar dimension from first to last day."""
    days = spark.sql(
        "SELECT explode(sequence(to_date(:first), to_date(:last))) AS full_date",
        args={"first": first, "last": last},
    )
    return calendar_columns(days)


def calendar_spanning(dates: DataFrame, column: str) -> DataFrame:
    """Calendar dimension from the first to the last date a table holds."""
    span = dates.agg(
        F.min(F.to_date(column)).alias("first"), F.max(F.to_date(column)).alias("last")
    )
    return calendar_columns(span.select(F.explode(F.sequence("first", "last")).alias("full_date")))
