"""tapelake: a Spark-first engine for archives of daily market-data files."""

__version__ = "0.1.0"
