"""Reading and writing: payloads, raw feeds, versioned tables, documents, models."""
