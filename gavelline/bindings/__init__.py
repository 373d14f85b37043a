"""Queries over the supplied tables, each next to the SQL that must give the same rows."""
