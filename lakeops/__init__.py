"""Metadata-driven lakehouse jobs on Apache Spark."""
