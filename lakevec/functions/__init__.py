"""Column functions: hashes of keys, vector codecs, distances, JSON."""
