"""Operators for training-data preparation over document and vector tables."""
