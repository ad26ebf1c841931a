"""Elevation tiles and training-data pipelines on Spark."""
