"""Training-data operators: packing, sharding, secret scans, byte-pair coding,
web archives, vector search, quality rules, near-duplicate and line dedup, and a
compressed token format.  Nothing else in the library imports this subpackage;
``queries.py`` registers one query per operator."""
