"""Integrity checks, scores and reports: DataFrame to DataFrame."""
