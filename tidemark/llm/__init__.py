"""Operators for training data: filters, near-duplicate search, mixing, packing, archives, fingerprints."""
