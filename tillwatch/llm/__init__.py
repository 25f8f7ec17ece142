"""Operators for training-data pipelines on documents, pages, vectors and conversations."""
