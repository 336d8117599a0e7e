"""recordlens: Spark-native operators for overlapping inspection-style record feeds."""

__version__ = "0.1.0"
