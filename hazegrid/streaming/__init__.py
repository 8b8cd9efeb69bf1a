"""Streams: the same feature definition as the batch jobs, fed as readings arrive."""
