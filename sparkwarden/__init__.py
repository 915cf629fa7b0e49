"""Session threat analytics on Spark: every job takes DataFrames and returns DataFrames."""

__version__ = "0.1.0"
