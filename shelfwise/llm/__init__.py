"""Operators for building training data out of web text."""
