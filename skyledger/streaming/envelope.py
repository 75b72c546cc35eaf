"""Event envelopes: building them from source rows and validating what arrives."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import iso_z, map_vocab, strip, uuid5
from ..functions.vocab import BOOKING_EVENT_TYPE, PAYMENT_EVENT_TYPE, Vocab
from ..sources.messages import BOOKING_TOPIC, PAYMENT_TOPIC


@dataclass(frozen=True)
class Kind:
    name: str
    topic: str
    key: str
    status: str
    time: str
    types: Vocab


BOOKING = Kind("booking", BOOKING_TOPIC, "booking_id", "booking_status", "booking_time", BOOKING_EVENT_TYPE)
PAYMENT = Kind("payment", PAYMENT_TOPIC, "payment_id", "payment_status", "payment_time", PAYMENT_EVENT_TYPE)

# The envelope.
SCHEMA_VERSION = 1
SOURCE_SYSTEM = "synthetic_streaming_demo"
REQUIRED_FIELDS = ["entity_key", "event_id", "event_time", "event_type", "payload", "schema_version", "source_system"]

# Landing table of each topic.
STREAM_TABLES = {BOOKING_TOPIC: "raw_booking_events_stream", PAYMENT_TOPIC: "raw_payment_events_stream"}


def _filled(df: DataFrame, *names: str) -> list[Column]:
    """The named columns that exist, with empty text as NULL."""
    return [F.nullif(F.col(name), F.lit("")) for name in names if name in df.columns]


def st_build_envelope(rows: DataFrame, kind: Kind, source_system: str = SOURCE_SYSTEM) -> DataFrame:
    """Envelopes of source rows; ``row_index`` is the record's place in its source, from 1 on."""
    index = F.col("row_index").cast("string")
    body = [name for name in rows.columns if name != "row_index"]
    identity = F.coalesce(*_filled(rows, "booking_id", "payment_id"), F.concat(F.lit("row-"), index))
    version = F.coalesce(*_filled(rows, "updated_at", "created_at"), F.lit(""))
    happened = F.coalesce(
        *_filled(rows, "updated_at", kind.time, "created_at"), F.current_timestamp().cast("string")
    )
    status = F.upper(strip(F.coalesce(kind.status, F.lit(""))))
    return rows.select(
        "row_index",
        F.concat(F.lit(f"{kind.name}-"), uuid5(F.concat_ws("|", identity, version, index))).alias("event_id"),
        map_vocab(status, kind.types).alias("event_type"),
        happened.alias("event_time"),
        F.lit(source_system).alias("source_system"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.coalesce(*_filled(rows, kind.key), F.concat(F.lit(f"missing-{kind.name}-"), index)).alias("entity_key"),
        F.struct(*body).alias("payload"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("produced_at"),
    )


def _once(df: DataFrame, *costly: Column) -> DataFrame:
    """Add columns that are computed once per row.

    A filter on a plain column is pushed below it by copying the expression into the filter, which would
    parse a message again for every mention. Filters do not pass a generator.
    """
    return df.select("*", F.inline(F.array(F.struct(*costly))))


def st_validate_envelope(messages: DataFrame) -> DataFrame:
    """Envelope columns of every message, with ``error_type`` and ``error_message`` where it is invalid.

    Nothing fails here: text that is not JSON, or not an object, is an error like any other. The first
    error found is kept: shape, missing fields, payload, time, topic, version.
    """
    parsed = _once(messages, F.try_parse_json("value").alias("_v"))

    def text(name: str) -> Column:
        return F.try_variant_get("_v", f"$.{name}", "string")

    payload = F.try_variant_get("_v", "$.payload", "variant")
    fields = parsed.select(
        "topic",
        "partition",
        "kafka_offset",
        "value",
        F.col("_v").isNotNull().alias("_json"),
        F.schema_of_variant("_v").startswith("OBJECT").alias("_object"),
        *[text(name).alias(name) for name in REQUIRED_FIELDS if name not in ("payload", "schema_version")],
        text("schema_version").alias("_version"),
        F.try_variant_get("_v", "$.schema_version", "int").alias("schema_version"),
        F.when(~F.is_variant_null(payload), F.to_json(payload)).alias("payload"),
        F.schema_of_variant(payload).startswith("OBJECT").alias("_payload_object"),
    ).withColumn("_at", iso_z("event_time"))

    def missing(name: str) -> Column:
        held = {"schema_version": "_version"}.get(name, name)
        empty = '""' if name == "payload" else ""
        return F.when(F.coalesce(F.col(held), F.lit(empty)) == empty, name)

    absent = F.concat_ws(", ", *[missing(name) for name in REQUIRED_FIELDS])
    quote = F.lit("'")
    version_error = F.concat(F.lit("invalid literal for int() with base 10: "), quote, "_version", quote)
    message = (
        F.when(~F.col("_json"), F.lit("message is not JSON"))
        .when(~F.col("_object"), F.lit("message must be an object"))
        .when(absent != "", F.concat(F.lit("Missing required envelope fields: "), absent))
        .when(~F.col("_payload_object"), F.lit("payload must be an object"))
        .when(F.col("_at").isNull(), F.concat(F.lit("Invalid isoformat string: "), quote, "event_time", quote))
        .when(~F.col("topic").isin(list(STREAM_TABLES)), F.concat(F.lit("Unsupported topic: "), "topic"))
        .when(F.col("schema_version").isNull(), version_error)
    )
    kind = (
        F.when(~F.col("_json"), "JSONDecodeError")
        .when(~F.col("_object"), "AttributeError")
        .when(message.isNotNull(), "ValueError")
    )
    judged = _once(fields, kind.alias("error_type"), message.alias("error_message"))
    return judged.select(
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        "kafka_offset",
        "value",
        "event_id",
        "event_type",
        F.col("_at").alias("event_time"),
        "source_system",
        "schema_version",
        "entity_key",
        "payload",
        "error_type",
        "error_message",
    )
