"""Training-data operators: dedup, quality, mixing, packing, archives and personal data."""
