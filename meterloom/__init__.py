"""meterloom: Spark-native analytics for meter and sensor telemetry."""
