"""Dataflow operators: functions from DataFrames to DataFrames."""
