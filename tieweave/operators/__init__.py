"""Normalizers, change reduction, edge derivation and data checks."""
