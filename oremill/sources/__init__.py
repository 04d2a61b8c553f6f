"""Readers: raw files, file manifests, stored tables."""
