"""Operators: functions from DataFrames to a DataFrame, lazy unless their text says otherwise."""
