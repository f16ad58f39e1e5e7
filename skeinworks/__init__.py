"""Nested-record warehouse and record-linkage engine on PySpark."""
