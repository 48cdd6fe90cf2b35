"""Strandweave: Spark-native molecule-resolved variant analytics."""

__version__ = "0.1.0"
