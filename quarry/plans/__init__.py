"""Composed jobs and the query registry behind __spark_entry__.py."""
