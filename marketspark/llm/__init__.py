"""Operators of a training-data pipeline: near copies, language, scores, mixing, packing, shards."""
