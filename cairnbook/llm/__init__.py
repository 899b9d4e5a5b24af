"""Operators for training-data pipelines: documents in, decisions with doc ids out."""
