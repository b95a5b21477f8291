"""The star-schema test tables, reshaped as feed lines (Spark) and as plain relations (SQL)."""
