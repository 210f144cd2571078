"""Delivery-success classifier on Spark ML."""
