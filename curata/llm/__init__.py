"""Training-data operators: cleaning, deduplication, tokenising, formatting, scanning, sharding.

Nothing outside this subpackage imports it; it can be deleted and the rest still works.
"""
