"""Sedimenta: corpus and dataset construction as Spark dataflows."""

__version__ = "0.1.0"
