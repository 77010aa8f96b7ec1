"""Training-data operators: language id, near-dedup, packing, mixing, quality rules,
media columns, secret scans, URL filters, LM scoring and line dedup.

Nothing outside this package imports it.
"""
