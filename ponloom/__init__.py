"""Telemetry and inventory analytics for fibre access networks, on Spark DataFrames."""
