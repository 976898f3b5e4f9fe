"""Reconciliation, returns and data-quality analytics for entity-by-date prices on Spark."""
