"""Structured Streaming: incremental training with foreachBatch and streaming aggregates."""
