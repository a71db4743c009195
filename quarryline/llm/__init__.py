"""Operators for preparing the training text of language models."""
