"""Hourly air-quality analytics over many stations, as Spark jobs."""
