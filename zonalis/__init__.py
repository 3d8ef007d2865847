"""zonalis: Spark DataFrame operators for location-tagged network telemetry."""

__version__ = "0.1.0"
