"""Batch analytics for city mobility data, written as Spark DataFrame programs."""
