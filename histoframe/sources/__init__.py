"""Readers and writers of the tables and metadata files around a slide."""
