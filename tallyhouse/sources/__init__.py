"""Readers: partitioned tables, JDBC, delimited text, and the test-data adapters."""
