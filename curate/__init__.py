"""Messy records in, trusted tables and grounded answers out, on Spark."""
