"""Failure-risk analytics for run-to-failure sensor fleets, on Spark DataFrames."""

__version__ = "0.1.0"
