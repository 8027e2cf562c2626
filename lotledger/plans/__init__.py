"""Composite jobs and the vehicle tables they start from."""
