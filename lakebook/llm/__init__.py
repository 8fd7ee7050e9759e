"""Operators of a training-data pipeline: clean, deduplicate, decontaminate, shard, pack."""
