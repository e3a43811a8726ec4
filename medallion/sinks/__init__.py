"""Sinks: versioned Parquet tables (manifest per version, bucketed segments) and file exports."""
