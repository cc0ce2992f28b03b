"""Readers: declared-schema files, archives, pages, JDBC and catalog tables."""
