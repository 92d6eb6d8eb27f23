"""lakevec: analytics over vector-bearing tables kept as column-per-file log segments, on Spark's public APIs."""
