"""Training-data operators: deduplication, filters, search, mixing, encoding."""
