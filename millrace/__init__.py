"""Warehouse operators for Spark tables and streams."""
