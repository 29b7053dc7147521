"""sievewright: Spark-first cleaning, merging and validation of captured catalog data."""

__version__ = "0.1.0"
