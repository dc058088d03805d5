"""Operators on text corpora: scans, deduplication, search, packing and extraction.

Nothing outside this package imports it. Each module holds one operator with a general
interface; `queries` applies them to the driver's tables.
"""
