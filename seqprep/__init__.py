"""Spark jobs that turn listing versions and click events into model-ready session sequences."""
