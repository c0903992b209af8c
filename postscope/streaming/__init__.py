"""Structured Streaming jobs: live statistics, comparison, stateful predictors."""
