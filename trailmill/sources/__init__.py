"""Readers, writers and the views over the driver's tables."""
