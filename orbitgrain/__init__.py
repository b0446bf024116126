"""Satellite-image analytics on tables, as Spark jobs."""
