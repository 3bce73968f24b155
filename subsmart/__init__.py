"""Subscription analytics on Spark: staging, dimensions, facts and quality jobs."""

__version__ = "0.1.0"
