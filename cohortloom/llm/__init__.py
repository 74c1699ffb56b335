"""Operators for training corpora, one module each, over a table of documents."""
