"""coverlake: a PySpark medallion engine for daily insurance feeds."""

__version__ = "0.1.0"
