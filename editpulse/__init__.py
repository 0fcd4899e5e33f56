"""Edit-stream analytics on Spark: land, clean, aggregate, correct, maintain."""

__version__ = "0.1.0"
