"""Hourly zone-demand lakehouse expressed as PySpark DataFrame, SQL and streaming plans."""
