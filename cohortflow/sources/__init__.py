"""Readers and writers; any Hadoop-compatible path."""
