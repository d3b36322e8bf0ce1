"""Transcript analytics as Spark DataFrame operators."""
