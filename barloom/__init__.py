"""Bars, signals and books on Spark: every operator takes and returns a DataFrame."""
