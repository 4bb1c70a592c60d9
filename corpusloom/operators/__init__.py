"""Operators: functions from DataFrames to DataFrames, without actions unless their docstring says so."""
