"""Compositions of operators: ingest, the daily table, publishing, registered queries."""
