"""Layers, metrics and reports. Transforms take and return DataFrames; only jobs touch tables."""
