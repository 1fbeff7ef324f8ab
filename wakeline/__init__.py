"""Wakeline: trajectory features and ensemble scoring as Spark jobs."""
