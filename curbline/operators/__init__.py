"""Data operators: functions from DataFrames to DataFrames, and the table writers in ``sinks``."""
