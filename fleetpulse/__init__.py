"""fleetpulse: fleet-telemetry analytics as plain PySpark DataFrame transformations."""
