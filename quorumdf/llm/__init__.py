"""Corpus operators for training-data pipelines.

Each operator lives in a module of its own; ``registry`` collects the thin
queries over the driver's tables.  Nothing outside this package imports it.
"""
