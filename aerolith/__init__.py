"""Environmental telemetry analytics on Spark: lake, rollups, live views and serving queries."""

__version__ = "0.1.0"
