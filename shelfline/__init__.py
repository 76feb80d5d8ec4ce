"""Retail sales cleaning and reporting as PySpark DataFrame functions."""
