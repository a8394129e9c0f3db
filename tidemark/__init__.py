"""Tidemark: channel, guide and title integration as Spark jobs."""
