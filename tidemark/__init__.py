"""tidemark: a PySpark-native analytics engine for attack-telemetry logs."""
