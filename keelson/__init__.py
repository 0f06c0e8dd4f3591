"""Keelson: finds out how loosely documented tables hang together, on Spark."""
