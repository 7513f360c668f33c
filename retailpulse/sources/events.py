"""Order events: reading the stream, decoding and encoding the payload."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailpulse.config import StreamParams
from retailpulse.schemas import ORDER_EVENT, REQUIRED_ORDER_FIELDS


def kafka_events(spark: SparkSession, params: StreamParams = StreamParams()) -> DataFrame:
    """(json, arrived_at) from the order topic; needs the Kafka connector jar."""
    options = {
        "kafka.bootstrap.servers": params.bootstrap_servers,
        "subscribe": params.topic,
        "startingOffsets": params.starting_offsets,
        "failOnDataLoss": "false",
    }
    if params.max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(params.max_offsets_per_trigger)
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select(
        F.col("value").cast("string").alias("json"), F.col("timestamp").alias("arrived_at")
    )


def file_events(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """The same stream from landed text files, one JSON document per line."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder).select(
        F.col("value").alias("json"), F.current_timestamp().alias("arrived_at")
    )


def decode(raw: DataFrame) -> DataFrame:
    """Payload fields beside the raw text; malformed text gives NULL fields.

    Selecting ``payload.*`` would let the optimizer parse the text again for
    every field; as a generator the parse runs once per message.
    """
    payload = F.inline(F.array(F.from_json("json", ORDER_EVENT)))
    return raw.select("json", "arrived_at", payload)


def is_complete() -> Column:
    return reduce(and_, [F.col(name).isNotNull() for name in REQUIRED_ORDER_FIELDS])


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.filter(is_complete()).drop("json")


def quarantined(decoded: DataFrame) -> DataFrame:
    return decoded.filter(~is_complete()).select("json", "arrived_at")


def read_orders(events: DataFrame, params: StreamParams = StreamParams()) -> DataFrame:
    """Well-formed orders of an event stream with an event-time watermark."""
    return accepted(decode(events)).withWatermark("order_timestamp", params.watermark)


def encode(orders: DataFrame) -> DataFrame:
    """(key, value) messages, keyed by order; the fields follow the schema."""
    fields = [name for name in ORDER_EVENT.fieldNames() if name in orders.columns]
    iso = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"}
    return orders.select(
        F.col("order_id").alias("key"), F.to_json(F.struct(*fields), iso).alias("value")
    )


def write_events(messages: DataFrame, params: StreamParams = StreamParams()) -> None:
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", params.bootstrap_servers)
        .option("topic", params.topic)
        .save()
    )
