"""Compositions: cleaned tables, marts, file ingest, and the refresh from raw files to marts."""
