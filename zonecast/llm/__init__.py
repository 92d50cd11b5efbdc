"""Operators of a training-data pipeline over large document tables.

Self-contained: nothing else in the library imports this subpackage.
"""
