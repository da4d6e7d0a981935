"""Spark-first curation of large text corpora."""
