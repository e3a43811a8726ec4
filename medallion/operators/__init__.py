"""Configurable DataFrame operators: filter, prepare, join, aggregate, percentile, unique, windows, CDC,
quality, sets, SQL node, classification.  Each returns lazy DataFrames built from built-in expressions."""
