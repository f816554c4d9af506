"""Readers: text, delimited records, access logs, change records, catalog tables, streams."""
