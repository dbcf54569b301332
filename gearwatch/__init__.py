"""Predictive-maintenance analytics over machine telemetry, on Spark DataFrames."""
