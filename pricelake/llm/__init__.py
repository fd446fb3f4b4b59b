"""Training-data operators: search, PII, tokenising, near duplicates, mixing, classifiers.

Nothing else in the library imports this subpackage.
"""
