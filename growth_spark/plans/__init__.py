"""Whole plans: roll-ups of samples and projects, tables that cut lineage."""
