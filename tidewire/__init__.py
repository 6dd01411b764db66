"""News sentiment analytics as Spark DataFrame operators, for tables and streams."""

__version__ = "0.1.0"
