"""Readers: raw lines, CSV and XML records, control tables, file listing."""
