"""Doorstep: last-mile delivery-attempt analytics on PySpark."""
