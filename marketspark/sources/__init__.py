"""Readers for landed files and the partitioned store."""
