"""Harmonise, load and publish periodic snapshot statistics with Spark DataFrames."""

__version__ = "0.1.0"
