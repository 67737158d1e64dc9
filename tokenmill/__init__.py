"""tokenmill: corpus preparation and byte-level BPE tokenization on Spark."""

__version__ = "0.1.0"
