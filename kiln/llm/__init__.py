"""Operators for large text corpora: quality, toxicity, near copies, secrets, packing,
tokenising, page text, url verdicts, sharding and nearest neighbours.

Nothing outside this subpackage imports it.
"""
