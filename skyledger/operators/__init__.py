"""Operators from DataFrame to DataFrame: rules, dedupe, upserts, audit, assertions, injection."""
