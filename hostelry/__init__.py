"""Lodging marketplace analytics expressed as lazy Spark DataFrame functions."""
