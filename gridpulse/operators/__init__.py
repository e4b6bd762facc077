"""Windowing, events, types, correlation and reporting over DataFrames."""
