"""Readers and writers: monthly files, zone files, event topics, keyed tables, star-schema adapters."""
