"""Structured Streaming flows: one query and checkpoint per source, foreachBatch bronze / silver / CDC."""
