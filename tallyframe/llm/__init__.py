"""Operators for building training data from web archives and documents, and the queries that apply them."""
