"""The version that reports name."""

__version__ = "0.3.0"
