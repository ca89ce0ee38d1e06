"""Spark-first corpus analytics: build, measure, filter and query speech and text corpora."""
