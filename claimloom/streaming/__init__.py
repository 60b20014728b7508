"""Structured Streaming counterparts: windowed gate metrics, arrivals without repeats, idempotent batches.

The reference has no streams; these are extensions on the same functions.
"""
