"""Readers and writers for page dumps, text lines and exported lists."""
