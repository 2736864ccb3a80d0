"""Operators for large-scale training-data preparation.

One module per operator; ``queries`` registers one query per operator and ``base`` holds what
they share. Nothing outside this subpackage imports it.
"""
