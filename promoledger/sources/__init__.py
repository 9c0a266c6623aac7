"""Readers and snapshot resolution."""
