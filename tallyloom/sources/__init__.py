"""Readers and writers: CSV folders, catalog tables, documents, JDBC."""
