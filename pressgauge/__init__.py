"""pressgauge: media-content telemetry on Spark DataFrames and Structured Streaming."""
