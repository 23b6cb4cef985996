"""Composite jobs (clean, enrich, report) and the registered query catalog."""
