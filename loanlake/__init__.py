"""Lending ETL and portfolio analytics as composable PySpark DataFrame transforms."""

__version__ = "0.1.0"
