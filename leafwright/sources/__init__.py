"""Readers and writers for landed site data."""
