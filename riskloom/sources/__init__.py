"""Readers, load patterns and the versioned parquet table they write."""
