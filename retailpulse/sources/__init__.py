"""Readers and writers: order events, retail tables, catalog documents."""
