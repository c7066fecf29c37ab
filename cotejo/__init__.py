"""Reconciliation, validation and refresh operators for long monthly facts on Spark."""

__version__ = "0.1.0"
