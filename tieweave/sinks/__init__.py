"""Keyed tables and the ledger of handled files."""
