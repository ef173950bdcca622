"""Operators that prepare text corpora for training, one module per operator.

Nothing else in the library imports this subpackage; ``queries`` registers its entries.
"""
