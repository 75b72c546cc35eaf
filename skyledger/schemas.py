"""Declared columns of every source and table."""

from __future__ import annotations

from pyspark.sql import types as T

# Flight file column -> raw column.
FLIGHT_COLUMNS = {
    "Year": "year",
    "Quarter": "quarter",
    "Month": "month",
    "DayofMonth": "day_of_month",
    "FlightDate": "flight_date",
    "Reporting_Airline": "reporting_airline",
    "Tail_Number": "tail_number",
    "Flight_Number_Reporting_Airline": "flight_number_reporting_airline",
    "Origin": "origin",
    "OriginCityName": "origin_city_name",
    "OriginState": "origin_state_abr",
    "Dest": "dest",
    "DestCityName": "dest_city_name",
    "DestState": "dest_state_abr",
    "CRSDepTime": "crs_dep_time",
    "DepTime": "dep_time",
    "DepDelay": "dep_delay",
    "DepDelayMinutes": "dep_delay_minutes",
    "TaxiOut": "taxi_out",
    "WheelsOff": "wheels_off",
    "WheelsOn": "wheels_on",
    "TaxiIn": "taxi_in",
    "CRSArrTime": "crs_arr_time",
    "ArrTime": "arr_time",
    "ArrDelay": "arr_delay",
    "ArrDelayMinutes": "arr_delay_minutes",
    "Cancelled": "cancelled",
    "CancellationCode": "cancellation_code",
    "Diverted": "diverted",
    "CRSElapsedTime": "crs_elapsed_time",
    "ActualElapsedTime": "actual_elapsed_time",
    "AirTime": "air_time",
    "Flights": "flights",
    "Distance": "distance",
    "CarrierDelay": "carrier_delay",
    "WeatherDelay": "weather_delay",
    "NASDelay": "nas_delay",
    "SecurityDelay": "security_delay",
    "LateAircraftDelay": "late_aircraft_delay",
}

INTEGER_COLUMNS = [
    "year", "quarter", "month", "day_of_month",
    "crs_dep_time", "dep_time", "wheels_off", "wheels_on", "crs_arr_time", "arr_time",
]

# Raw tables: column -> type after load. Money is exact, measures are doubles.
RAW_FLIGHTS = {
    name: "int" if name in INTEGER_COLUMNS else "double" for name in FLIGHT_COLUMNS.values()
} | {
    name: "string"
    for name in (
        "reporting_airline", "tail_number", "flight_number_reporting_airline", "origin", "origin_city_name",
        "origin_state_abr", "dest", "dest_city_name", "dest_state_abr", "cancellation_code",
    )
} | {"flight_date": "date"}

RAW_AIRPORTS = {
    "id": "bigint", "ident": "string", "type": "string", "name": "string", "latitude_deg": "double",
    "longitude_deg": "double", "elevation_ft": "double", "continent": "string", "iso_country": "string",
    "iso_region": "string", "municipality": "string", "scheduled_service": "string", "gps_code": "string",
    "iata_code": "string", "local_code": "string", "home_link": "string", "wikipedia_link": "string",
    "keywords": "string",
}
RAW_COUNTRIES = {
    "id": "bigint", "code": "string", "name": "string", "continent": "string",
    "wikipedia_link": "string", "keywords": "string",
}
RAW_REGIONS = {
    "id": "bigint", "code": "string", "local_code": "string", "name": "string", "continent": "string",
    "iso_country": "string", "wikipedia_link": "string", "keywords": "string",
}
RAW_BOOKINGS = {
    "booking_id": "string", "customer_id": "string", "flight_id": "string", "flight_date": "date",
    "airline": "string", "origin_airport": "string", "destination_airport": "string", "route": "string",
    "booking_time": "timestamp_ntz", "booking_channel": "string", "customer_segment": "string",
    "ticket_price": "decimal(18,2)", "currency": "string", "booking_status": "string",
    "payment_status": "string", "is_refunded": "string", "created_at": "timestamp_ntz",
    "updated_at": "timestamp_ntz",
}
RAW_PAYMENTS = {
    "payment_id": "string", "booking_id": "string", "payment_time": "timestamp_ntz",
    "payment_method": "string", "payment_status": "string", "amount": "decimal(18,2)", "currency": "string",
    "refund_amount": "decimal(18,2)", "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz",
}

# Columns a source file must have.
REQUIRED_COLUMNS = {
    "bts": ["FlightDate", "Reporting_Airline", "Origin", "Dest", "Cancelled", "Diverted"],
    "airports": ["ident", "type", "name", "iso_country", "iso_region", "iata_code"],
    "bookings": ["booking_id", "customer_id", "flight_id", "flight_date", "ticket_price"],
    "payments": ["payment_id", "booking_id", "payment_status", "amount"],
}

RAW_TABLE_OF = {
    "bts": "raw_bts_flights",
    "airports": "raw_airports",
    "countries": "raw_countries",
    "regions": "raw_regions",
    "bookings": "raw_bookings",
    "payments": "raw_payments",
}


def text_schema(columns) -> T.StructType:
    """Every column as text, the way a delimited file holds it."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


LOAD_AUDIT = (
    "load_audit_id string, run_id string, source_name string, target_table string, file_path string, "
    "checksum_md5 string, source_rows bigint, valid_rows bigint, quarantined_rows bigint, inserted_rows bigint, "
    "skipped_rows bigint, load_status string, started_at timestamp, completed_at timestamp, error_message string"
)
FILE_REGISTRY = (
    "file_id string, source_name string, file_path string, partition_key string, file_size_bytes bigint, "
    "row_count bigint, checksum_md5 string, load_status string, started_at timestamp, completed_at timestamp, "
    "error_message string"
)
RUN_LOG = (
    "run_id string, dag_id string, execution_date timestamp, source_count bigint, total_input_rows bigint, "
    "total_loaded_rows bigint, dbt_status string, test_status string, runtime_seconds double, created_at timestamp"
)
JOB_AUDIT = (
    "job_run_id string, job_name string, source_flight_rows bigint, source_booking_rows bigint, "
    "output_route_delay_rows bigint, output_route_booking_rows bigint, status string, started_at timestamp, "
    "completed_at timestamp, error_message string"
)
