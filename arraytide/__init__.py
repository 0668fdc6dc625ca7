"""Array time-series quality control and cross-station analysis as Spark DataFrame plans."""

__version__ = "0.1.0"
