"""Feeder-reliability analytics as Spark DataFrame jobs."""
