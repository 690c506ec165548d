"""Cairn: a Spark-first analytics engine for coded event data and text corpora."""
