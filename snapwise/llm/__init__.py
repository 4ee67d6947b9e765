"""Training-data operators: scoring, filtering, near-duplicates, mixing,
packing, token files, WARC archives and chat formatting.

Nothing outside this folder imports it; ``queries.py`` and ``oracle.py`` here
hold the registered queries and their SQL.
"""
