"""Scans, sinks, spools and run manifests."""
