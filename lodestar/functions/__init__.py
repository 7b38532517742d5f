"""Column functions: text, hashes, vectors, JSON."""
