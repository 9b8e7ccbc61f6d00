"""Composed queries: dashboard and serving models, and the lakehouse from bronze to warehouse."""
