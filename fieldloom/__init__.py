"""fieldloom: Spark-first analytics over ordered event data."""

__version__ = "0.1.0"
