"""Spark jobs that turn multi-sensor recordings into a clean, queryable mart."""

__version__ = "1.0.0"
