"""Lakeworks: analytics on file-based data lakes, written as plain PySpark."""
