"""postscope: per-topic statistics, comparisons and online predictors for
streams and archives of short posts, on Spark DataFrames and Structured
Streaming."""

__version__ = "0.1.0"
