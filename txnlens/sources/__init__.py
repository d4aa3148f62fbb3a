"""Readers for files, landing folders, tables and message streams."""
