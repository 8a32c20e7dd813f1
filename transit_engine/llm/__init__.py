"""Operators that prepare text and vectors for training, each with its query in ``queries``."""
