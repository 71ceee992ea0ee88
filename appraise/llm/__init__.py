"""Training-data operators: quality rules, deduplication, scoring, mixing, packing.

Nothing outside this subpackage imports it. ``catalog.QUERIES`` holds the
registered queries and ``catalog.ORACLES`` their SQL forms.
"""
