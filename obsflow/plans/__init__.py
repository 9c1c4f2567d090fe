"""Composite jobs and the driver-table role mapping."""
