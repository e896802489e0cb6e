"""Operators: functions from DataFrames to DataFrames, lazy unless the docstring says otherwise."""
