"""ledgerlake: bank detail loads, marts and delta mirrors as Spark DataFrame jobs."""

__version__ = "0.1.0"
