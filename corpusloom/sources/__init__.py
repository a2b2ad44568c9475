"""Readers for article files, ranked lists, landed web data and the chunk index."""
