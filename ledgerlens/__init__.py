"""Spark-first analytics over public disclosures."""
