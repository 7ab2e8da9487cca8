"""Readers for the lake and for the driver tables."""
