"""Readers: landed tables, catalog documents, delimited files, JDBC."""
