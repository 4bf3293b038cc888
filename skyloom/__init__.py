"""Medallion data processing on Spark: raw documents to a checked star schema."""
