"""Readers and writers: files, keyed tables, odds pages."""
