"""Operators for preparing training corpora: scans, filters, deduplication, encoding, packing."""
