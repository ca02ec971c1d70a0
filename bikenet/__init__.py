"""Station-network analytics expressed as PySpark DataFrame operators."""

__version__ = "0.1.0"
