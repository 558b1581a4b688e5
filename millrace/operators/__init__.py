"""Operators over DataFrames: dedup, cleaning, rules, history, checks, run-log analytics."""
