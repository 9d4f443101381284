"""Readers and writers, and a data source for the station directory."""
