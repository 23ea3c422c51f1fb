"""Road-telemetry and sensor-stream analytics on Spark DataFrames."""
