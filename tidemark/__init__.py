"""Dimensional modelling and table maintenance on PySpark."""
