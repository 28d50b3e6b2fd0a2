"""Operators of a training-data pipeline over documents, pages and embeddings; nothing outside this folder imports it."""
