"""Operators on DataFrames: deletes, positional zips, keys, nearest neighbours, statistics."""
