"""Operators for training data: runs of events, mergeable percentiles, packing, leakage, subjects."""
