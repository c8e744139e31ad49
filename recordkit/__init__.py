"""Record-keeping analytics on Spark: every operator takes and returns a DataFrame."""

__version__ = "0.1.0"
