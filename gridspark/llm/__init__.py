"""Training-data operators: near-duplicates, quality, mixing, formats, tokens."""
