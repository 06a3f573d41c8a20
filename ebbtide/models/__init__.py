"""Preparation, learners and parameter search on pyspark.ml."""
