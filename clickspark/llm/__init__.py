"""Training-data pipeline operators: licence scans, quality rules, near-duplicate
detection, search, tokenization, language identification, packing, URL filters
and chat formatting. Nothing else in the library imports this package."""
