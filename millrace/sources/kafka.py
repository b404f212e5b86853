"""Kafka topics as message rows.

``kafka_messages`` is a projection of Spark's Kafka source columns, so it serves batch and
streaming reads alike. The connector itself is the public ``spark-sql-kafka`` package.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.names import require_columns
from millrace.functions.text import last_of_each

# Defaults of the read.
BOOTSTRAP_SERVERS = ("localhost:9092",)
START_POSITION = "earliest"


def kafka_options(
    topic: str,
    *,
    bootstrap_servers=BOOTSTRAP_SERVERS,
    auto_offset_reset: str = START_POSITION,
    group_id: str | None = None,
    max_messages: int | None = None,
    streaming: bool = False,
) -> dict[str, str]:
    """Options of Spark's Kafka source for one topic.

    A batch read ends at the latest offset known at the start ("what is there now"); a stream
    takes ``max_messages`` per micro-batch. ``group_id`` only names the consumer: progress
    is kept in the stream's checkpoint, after the load, not in the group.
    """
    if not topic:
        raise ValueError("a topic name is required")
    if auto_offset_reset not in ("earliest", "latest"):
        raise ValueError(f"auto_offset_reset must be earliest or latest, not {auto_offset_reset!r}")
    servers = bootstrap_servers if isinstance(bootstrap_servers, str) else ",".join(bootstrap_servers)
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": auto_offset_reset,
        "includeHeaders": "true",
    }
    if group_id:
        options["kafka.group.id"] = group_id
    if streaming:
        if max_messages is not None:
            options["maxOffsetsPerTrigger"] = str(max_messages)
    else:
        if auto_offset_reset == "latest":
            raise ValueError('a batch read from "latest" would read nothing; read a stream, which keeps its place')
        options["endingOffsets"] = "latest"
    return options



def _headers_map(df: DataFrame) -> Column:
    """Header list -> MAP<STRING, BINARY>; of a repeated key the last value stays."""
    empty = F.create_map().cast("map<string,binary>")
    if "headers" not in df.columns:
        return empty
    headers = F.col("headers")
    if isinstance(df.schema["headers"].dataType, T.MapType):
        return F.coalesce(headers, empty)
    return F.coalesce(F.map_from_entries(last_of_each(headers, "key")), empty)


def kafka_messages(df: DataFrame, *, rejects: bool = False) -> DataFrame:
    """Kafka source rows -> raw_value, topic, partition, offset, timestamp (ms), key, headers.

    Value and key are read as UTF-8, empty bytes as NULL. A row whose value or key is not
    UTF-8 is a reject: left out here, and what ``rejects=True`` returns instead, with its
    raw bytes and ``parse_error``.
    """
    require_columns(df, "value", "key", "topic", "partition", "offset", "timestamp")
    value, key = F.col("value").cast("binary"), F.col("key").cast("binary")
    value_text, key_text = value.cast("string"), key.cast("string")
    bad_value = ~F.coalesce(F.is_valid_utf8(value_text), F.lit(True))
    bad_key = ~F.coalesce(F.is_valid_utf8(key_text), F.lit(True))
    position = ["topic", "partition", "offset"]
    if rejects:
        error = F.when(bad_value, "value is not UTF-8").otherwise("key is not UTF-8")
        return df.where(bad_value | bad_key).select(
            *position, value.alias("value"), key.alias("key"), error.alias("parse_error")
        )
    timestamp = df.schema["timestamp"].dataType
    millis = F.col("timestamp") if isinstance(timestamp, T.LongType) else F.unix_millis("timestamp")
    return df.where(~bad_value & ~bad_key).select(
        F.when(F.octet_length(value) > 0, value_text).alias("raw_value"),
        *position,
        millis.alias("timestamp"),
        F.when(F.octet_length(key) > 0, key_text).alias("key"),
        _headers_map(df).alias("headers"),
    )


def plan_offsets(available: DataFrame, messages: int) -> DataFrame:
    """(topic, partition, start, end): ``messages`` messages dealt over partitions by what each holds.

    ``available`` has a row per partition with the first offset and the one behind the last. Shares are
    whole numbers that add up to ``messages``, or to all there is: rounded down, what is left goes to the
    largest fractions (ties: topic, partition). Partitions without a share have ``end`` equal to ``start``.
    The windows are one task of a row per partition of the topics.
    """
    if messages < 0:
        raise ValueError("a number of messages cannot be negative")
    require_columns(available, "topic", "partition", "start", "end")
    wide = "decimal(38,0)"
    # an empty or expired partition may name an end before its start: it holds nothing
    held = F.greatest(F.col("end") - F.col("start"), F.lit(0)).cast("decimal(19,0)")
    rows = available.select("topic", "partition", "start", held.alias("held"))
    rows = rows.withColumn("total", F.sum("held").over(Window.partitionBy()).cast("decimal(19,0)"))
    wanted = F.least(F.lit(messages).cast("decimal(19,0)"), F.col("total"))
    product = (F.col("held") * wanted).cast(wide)
    rows = rows.select("topic", "partition", "start", "total", wanted.alias("wanted"), product.alias("product"))
    some = F.col("total") > 0
    rest = F.when(some, F.col("product") % F.col("total")).otherwise(0).cast(wide)
    share = F.when(some, ((F.col("product") - rest) / F.col("total")).cast("long")).otherwise(0)
    rows = rows.select("topic", "partition", "start", "wanted", rest.alias("rest"), share.alias("share"))
    left = F.col("wanted").cast("long") - F.sum("share").over(Window.partitionBy())
    place = F.row_number().over(Window.orderBy(F.col("rest").desc(), "topic", "partition"))
    rows = rows.select("topic", "partition", "start", "share", left.alias("left"), place.alias("place"))
    end = F.col("start") + F.col("share") + F.when(F.col("place") <= F.col("left"), 1).otherwise(0)
    return rows.select("topic", "partition", "start", end.alias("end"))


def offset_options(plan: DataFrame) -> dict[str, str]:
    """``startingOffsets`` and ``endingOffsets`` of a plan; a row per partition reaches the driver."""
    texts: dict[str, dict] = {"startingOffsets": {}, "endingOffsets": {}}
    for row in plan.select("topic", "partition", "start", "end").orderBy("topic", "partition").collect():
        texts["startingOffsets"].setdefault(row["topic"], {})[str(row["partition"])] = row["start"]
        texts["endingOffsets"].setdefault(row["topic"], {})[str(row["partition"])] = row["end"]
    return {name: json.dumps(text) for name, text in texts.items()}


def read_kafka(
    spark: SparkSession,
    topic: str,
    *,
    streaming: bool = False,
    max_messages: int | None = None,
    available: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Messages of a topic. ``max_messages`` caps a batch read, or each streaming trigger.

    With ``available``, the offsets of the topic's partitions, a capped batch reads exactly the planned
    ranges, in a task per partition; without it Spark takes the first messages through one task.
    """
    if available is not None:
        if streaming or max_messages is None:
            raise ValueError("planned offsets are for a batch read with max_messages")
        plan = plan_offsets(available.where(F.col("topic") == topic), max_messages)
        settings = kafka_options(topic, **options) | offset_options(plan)
        return kafka_messages(spark.read.format("kafka").options(**settings).load())
    settings = kafka_options(topic, streaming=streaming, max_messages=max_messages, **options)
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    messages = kafka_messages(reader.options(**settings).load())
    return messages.limit(max_messages) if max_messages is not None and not streaming else messages
