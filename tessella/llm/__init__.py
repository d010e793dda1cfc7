"""Training-data operators: scoring, search, deduplication, mixing, redaction, packing.

Nothing outside this subpackage imports it; it can be deleted as a whole.
"""
