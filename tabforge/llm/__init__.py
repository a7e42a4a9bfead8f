"""Training-data operators (tokens, sharding, mixing, quality, near duplicates, ...).

Nothing else in the library imports this subpackage.
"""
