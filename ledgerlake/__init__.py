"""Brokerage lakehouse analytics as Spark DataFrame operators."""
