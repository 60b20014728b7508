"""Operators for training data and noisy records; nothing outside this subpackage imports it."""
