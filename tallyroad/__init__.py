"""Operational metrics from a feed of database change messages, on PySpark."""
