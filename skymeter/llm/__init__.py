"""Operators on text corpora, vectors and web pages for preparing training data."""
