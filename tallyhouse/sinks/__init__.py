"""Writers: partitioned metrics table, delimited text, JDBC export."""
