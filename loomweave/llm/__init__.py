"""Training-data operators: language ID, dedup, mixing, packing, search, extraction.

Nothing else in the library imports this package; ``__spark_entry__`` adds its
queries only when the package is present.
"""
