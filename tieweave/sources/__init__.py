"""Readers for seed files, change files and change envelopes."""
