"""Whole pipelines, their registry of queries and the matching SQL."""
