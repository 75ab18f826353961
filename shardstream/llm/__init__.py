"""Operators for preparing training data at scale: scans, filters, near copies, sharding, packing, search, classifiers."""
