"""Readers, writers, keyed result logs, and views that map the given tables to flights."""
