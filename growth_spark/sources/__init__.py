"""Readers: catalogue tables, series payloads, pattern graphs, spectra, files."""
