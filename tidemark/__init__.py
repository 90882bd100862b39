"""Snapshot-history analytics as Spark DataFrame operators."""
