"""gridloom: web-table ingestion, profiling and loading on Spark."""

__version__ = "0.1.0"
