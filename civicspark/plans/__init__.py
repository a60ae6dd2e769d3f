"""Pipelines and domain queries, put together from the operators."""
