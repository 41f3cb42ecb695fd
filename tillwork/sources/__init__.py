"""Readers: relational databases, JSON, XML and CSV files."""
