"""Relational operators: statistics, comparison, predictors."""
