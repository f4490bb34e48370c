"""Queries over the sample tables and the SQL that gives the same answers."""
