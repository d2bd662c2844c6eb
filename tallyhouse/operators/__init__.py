"""Grouped metric operators built from DataFrame joins, aggregates and windows."""
