"""trendlens: text-corpus curation and event time-series analytics on PySpark."""

__version__ = "0.1.0"
