"""Whole pipelines: live collections, restored backups, embedded texts."""
