"""Operators for training data: text, web pages, conversations and vectors."""
