"""Operators for preparing training text: dedup, packing, tokenising, classifying.

Nothing else in the package imports this folder.
"""
