"""Event envelopes, idempotent landing, dead letters and stream reconciliation."""
