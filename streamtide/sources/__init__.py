"""Readers: delimited text, landed JSON documents, tables."""
