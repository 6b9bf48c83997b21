"""Training-data operators: search, decontamination, mixing, classifiers, PII, dedup and extraction.

Nothing else in the library imports this subpackage.  ``registry`` holds the
``opN_*`` queries and their oracle SQL.
"""
