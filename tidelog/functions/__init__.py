"""Column-level building blocks: hashing, headers, payload codecs."""
