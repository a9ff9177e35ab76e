"""Rental-listings analytics on Spark: raw -> staging -> marts, checks, metrics."""

__version__ = "0.1.0"
