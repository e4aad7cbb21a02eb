"""weftline: record linkage and deduplication as declarative Spark plans."""

__version__ = "0.1.0"
