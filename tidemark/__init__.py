"""Interval-based batch and micro-batch analytics written as Spark DataFrame operators."""
