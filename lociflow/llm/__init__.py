"""Training-data operators: mixing, deduplication, scanning, search, sharding, quality and tokenisation.

Nothing outside this subpackage imports it.
"""
