"""Training-data operators: scans, joins, packing, mixing, search and fingerprints over document tables.

Nothing outside this folder imports it; `queries.py` holds the registered queries.
"""
