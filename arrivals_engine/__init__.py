"""Border-arrival records to a checked star schema and reports, on Spark."""
