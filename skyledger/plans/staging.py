"""Cleaned sources: one row per flight record, airport record, booking and payment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    abs_value,
    blank_to_null,
    bool_words,
    default,
    first_present,
    floor_at,
    map_vocab,
    md5_key,
    route,
    strip_terminal,
    token_replace_first,
    token_trim_first,
    trim_lower,
    trim_upper,
)
from ..functions.vocab import BOOKING_CHANNEL, BOOKING_STATUS, CUSTOMER_SEGMENT, PAYMENT_METHOD, PAYMENT_STATUS
from ..operators.dedupe import keep_latest
from ..operators.filters import drop_blank_key, not_null_all

TOKEN_ORDER = {"replace_first": token_replace_first, "trim_first": token_trim_first}
VERSION_ORDER = ["updated_at", "loaded_at", "row_number"]  # the record number settles ties


def stg_flights(raw_flights: DataFrame) -> DataFrame:
    def or_zero(name: str) -> Column:
        return default(name, 0.0)

    return not_null_all(raw_flights, "flight_date", "origin", "dest").select(
        md5_key(
            "reporting_airline", "flight_number_reporting_airline", "flight_date", "origin", "dest"
        ).alias("flight_id"),
        "flight_date",
        F.col("reporting_airline").alias("airline"),
        "tail_number",
        F.col("flight_number_reporting_airline").alias("flight_number"),
        F.col("origin").alias("origin_airport"),
        F.col("dest").alias("destination_airport"),
        route("origin", "dest").alias("route"),
        "crs_dep_time",
        "dep_time",
        or_zero("dep_delay_minutes").alias("dep_delay_minutes"),
        "crs_arr_time",
        "arr_time",
        or_zero("arr_delay_minutes").alias("arr_delay_minutes"),
        or_zero("cancelled").cast("int").alias("cancelled"),
        "cancellation_code",
        or_zero("diverted").cast("int").alias("diverted"),
        or_zero("distance").alias("distance_miles"),
        or_zero("carrier_delay").alias("carrier_delay"),
        or_zero("weather_delay").alias("weather_delay"),
        or_zero("nas_delay").alias("nas_delay"),
        or_zero("security_delay").alias("security_delay"),
        or_zero("late_aircraft_delay").alias("late_aircraft_delay"),
        "loaded_at",
    )


def stg_airports(raw_airports: DataFrame) -> DataFrame:
    code = first_present("iata_code", "gps_code", "ident")
    return raw_airports.where(code.isNotNull()).select(
        trim_upper(code).alias("airport_code"),
        trim_upper("ident").alias("ident"),
        trim_lower("type").alias("airport_type"),
        F.trim("name").alias("airport_name"),
        "latitude_deg",
        "longitude_deg",
        "elevation_ft",
        trim_upper("iso_country").alias("iso_country"),
        trim_upper("iso_region").alias("iso_region"),
        blank_to_null("municipality").alias("municipality"),
        trim_lower("scheduled_service").alias("scheduled_service"),
        "loaded_at",
    )


def booking_versions(raw_bookings: DataFrame, token_order: str = "replace_first") -> DataFrame:
    """Every version of each booking with a key, with codes, statuses and prices standardised, and its record number."""
    token = TOKEN_ORDER[token_order]
    return drop_blank_key(raw_bookings, "booking_id").select(
        trim_upper("booking_id").alias("booking_id"),
        default(F.nullif(trim_upper("customer_id"), F.lit("")), "UNKNOWN_CUSTOMER").alias("customer_id"),
        trim_upper("flight_id").alias("flight_id"),
        "flight_date",
        trim_upper("airline").alias("airline"),
        strip_terminal("origin_airport").alias("origin_airport"),
        strip_terminal("destination_airport").alias("destination_airport"),
        "booking_time",
        map_vocab(token("booking_channel"), BOOKING_CHANNEL).alias("booking_channel"),
        map_vocab(token("customer_segment"), CUSTOMER_SEGMENT).alias("customer_segment"),
        abs_value("ticket_price").alias("ticket_price"),
        trim_upper("currency").alias("currency"),
        map_vocab(token("booking_status"), BOOKING_STATUS).alias("booking_status"),
        map_vocab(token("payment_status"), PAYMENT_STATUS).alias("payment_status"),
        bool_words("is_refunded").alias("is_refunded"),
        "created_at",
        floor_at("updated_at", F.col("created_at")).alias("updated_at"),
        "loaded_at",
        "row_number",
    )


def stg_bookings(raw_bookings: DataFrame, token_order: str = "replace_first") -> DataFrame:
    """Latest version of each booking, with codes, statuses and prices standardised.

    ``replace_first`` turns padding into underscores, so a padded status falls to its default;
    ``trim_first`` reads it as the bare status.
    """
    return current_bookings(keep_latest(booking_versions(raw_bookings, token_order), ["booking_id"], VERSION_ORDER))


def current_bookings(latest: DataFrame) -> DataFrame:
    """The columns of the staging model, of versions that are the latest of their bookings."""
    return latest.select(
        "booking_id",
        "customer_id",
        "flight_id",
        "flight_date",
        "airline",
        "origin_airport",
        "destination_airport",
        route("origin_airport", "destination_airport").alias("route"),
        "booking_time",
        "booking_channel",
        "customer_segment",
        "ticket_price",
        "currency",
        "booking_status",
        "payment_status",
        "is_refunded",
        "created_at",
        "updated_at",
        "loaded_at",
    )


def stg_payments(raw_payments: DataFrame, token_order: str = "replace_first") -> DataFrame:
    """Latest version of each payment; amounts below zero, and missing ones, become zero."""
    token = TOKEN_ORDER[token_order]
    nothing = F.lit(0).cast("decimal(18,2)")
    clean = drop_blank_key(raw_payments, "payment_id").select(
        trim_upper("payment_id").alias("payment_id"),
        trim_upper("booking_id").alias("booking_id"),
        "payment_time",
        map_vocab(token("payment_method"), PAYMENT_METHOD).alias("payment_method"),
        map_vocab(token("payment_status"), PAYMENT_STATUS).alias("payment_status"),
        floor_at("amount", nothing).alias("amount"),
        trim_upper("currency").alias("currency"),
        floor_at("refund_amount", nothing).alias("refund_amount"),
        "created_at",
        floor_at("updated_at", F.col("created_at")).alias("updated_at"),
        "loaded_at",
        "row_number",
    )
    return keep_latest(clean, ["payment_id"], VERSION_ORDER).drop("row_number")
