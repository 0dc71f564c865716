"""Event topics: stream sources and JSON decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow.model import topic_schema
from parcelflow.settings import StreamSettings

_CORRUPT = "_corrupt"


def kafka_topic(
    spark: SparkSession, bootstrap: str, topic: str, settings: StreamSettings | None = None
) -> DataFrame:
    """Raw topic stream: text value with its partition and offset."""
    settings = settings or StreamSettings()
    options = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": settings.max_offsets[topic],
        "failOnDataLoss": "false",
        "kafka.fetch.min.bytes": "1",
    }
    rows = spark.readStream.format("kafka").options(**options).load()
    return rows.select(
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("value").cast("string").alias("raw_value"),
    )


def file_topic(
    spark: SparkSession, path: str, files_per_trigger: int = 1, fmt: str = "text"
) -> DataFrame:
    """The same shape from a folder of JSON lines, or of parquet rows with a ``value``."""
    reader = spark.readStream.format(fmt).option("maxFilesPerTrigger", files_per_trigger)
    if fmt == "text":
        rows = reader.load(path)
        return rows.select(
            F.lit(None).cast("int").alias("kafka_partition"),
            F.lit(None).cast("bigint").alias("kafka_offset"),
            F.col("value").alias("raw_value"),
        )
    schema = "kafka_partition int, kafka_offset bigint, value string"
    rows = reader.schema(schema).load(path)
    return rows.select("kafka_partition", "kafka_offset", F.col("value").alias("raw_value"))


def decode(raw: DataFrame, topic: str) -> DataFrame:
    """JSON text -> typed columns, with the text itself and whether all of it could be read.

    Unreadable fields become null, and so perhaps invalid; a text that is no JSON object is null throughout. A filter on a field
    isn't moved below the explode of the one event, where each mention of a field would parse the text again.
    """
    schema = T.StructType([*topic_schema(topic), T.StructField(_CORRUPT, T.StringType())])
    event = F.from_json("raw_value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    return raw.select("kafka_partition", "kafka_offset", "raw_value", F.explode(F.array(event)).alias("event")).select(
        "event.*", "kafka_partition", "kafka_offset", F.current_timestamp().alias("ingest_time"), "raw_value",
        # Spark gives no object at all for an empty text.
        (F.col(f"event.{_CORRUPT}").isNotNull() | F.col("event").isNull()).alias("unreadable"),
    ).drop(_CORRUPT)
