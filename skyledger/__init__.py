"""Trusted analytics tables for flight operations, bookings and payments, on Spark DataFrames."""
