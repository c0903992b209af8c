"""Column expressions: text measures, tagging, time, JSON normalising."""
