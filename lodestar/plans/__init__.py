"""The query catalogue on the test tables, and the SQL of each query."""
