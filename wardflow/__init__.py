"""Batch analytics over hospital visits and reviews, written as Spark DataFrame jobs."""
