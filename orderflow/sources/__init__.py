"""Readers for message streams, message files, the dimension and result tables."""
