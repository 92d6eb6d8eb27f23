"""Readers: column log files, delete logs, backup metadata, wrapped JSON rows."""
