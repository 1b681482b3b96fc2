"""Operators for training-data corpora: filters, scores, near-duplicates, packing, placement, archives."""
