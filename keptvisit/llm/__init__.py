"""Operators for text corpora and embeddings; nothing else in the package imports them."""
