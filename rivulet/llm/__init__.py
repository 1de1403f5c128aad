"""Operators for preparing text corpora: search, filters, classifiers, deduplication and packing.

Each module holds one operator with a general interface; ``queries`` registers one query per
operator. Nothing else in the library imports this subpackage.
"""
