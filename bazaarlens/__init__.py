"""Marketplace analytics expressed as Spark DataFrame transforms."""
