"""fleetscope: fleet-telemetry analytics on the PySpark DataFrame API."""
