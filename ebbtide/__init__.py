"""Subscription and engagement analytics as Spark DataFrame operators."""
