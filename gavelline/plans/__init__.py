"""Whole runs made of operators: ingest, weekly reports, news and the catalogue."""
