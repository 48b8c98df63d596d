"""Readers for the driver's tables, their binding to the star schema, and landed JSON."""
