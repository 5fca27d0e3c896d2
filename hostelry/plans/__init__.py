"""Datasets, answers and jobs composed from the operators."""
