"""Training-data operators: counts, cleaning, deduplication, search, packing and scoring.

Nothing else in the library imports this subpackage.
"""
