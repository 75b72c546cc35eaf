"""The warehouse models: staging, dimensions, facts, intermediates, marts, features, reports."""
