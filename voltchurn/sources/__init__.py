"""Readers, writers and the stand-in views over the driver's test tables."""
