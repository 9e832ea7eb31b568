"""Composite jobs (what a user calls) and the registered query catalogue."""
