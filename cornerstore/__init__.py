"""Retail analytics and lakehouse operators as plain Spark DataFrame functions."""
