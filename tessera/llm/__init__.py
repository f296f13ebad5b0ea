"""Training-data operators: text extraction, deduplication, filtering, scans and packing.

Nothing outside this subpackage imports it. Each operator module offers a general DataFrame
function; ``queries`` holds the registered queries and their oracle SQL.
"""
