"""Layered lake jobs (bronze, silver, gold) written as Spark DataFrame transformations."""

__version__ = "0.1.0"
